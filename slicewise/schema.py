"""Names, keys and thresholds of image quality control. Fixed values, which results depend on."""

CHANNELS = ["dna", "mito", "er", "agp", "brightfield"]
ORGANOID = ["plate", "well", "site"]
ZSLICE = [*ORGANOID, "zslice"]

# Text in a file name that tells its channel, in the order in which it is looked for.
CHANNEL_TEXT = {"405": "DNA", "488": "ER", "555": "AGP", "640": "Mito", "TRANS": "Brightfield"}

# Z-scores beyond which a slice is blurred (slope of the power spectrum, below) or saturated (percent of
# pixels at the maximum, above).
BLUR = {"dna": -2.0, "mito": -3.0, "er": -2.0, "agp": -2.25, "brightfield": -3.0}
SATURATION = {"dna": 8.0, "mito": 6.0, "er": 2.0, "agp": 4.0, "brightfield": 10.0}

FLAGS = [f"{kind}_{c}" for kind in ("blurry", "saturated") for c in CHANNELS]

FOLDER = r"(NF[0-9]{4})_raw_images/([C-G][0-9]{1,2})-([0-9])"
FILE = r"([0-9]{3}|TRANS)_(ZS[0-9]{3})"
EXPECTED_FILES = 5
EXPECTED_RESULTS = 8
EXTRA_FOLDERS = [("NF0014", "C12-0 acq"), ("NF0018", "G12-1 acq")]
