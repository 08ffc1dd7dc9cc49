"""Token counts of texts under a byte-level BPE vocabulary, by the whole-token shortcut."""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Merged pre-tokens that one Python worker remembers before it starts afresh.
REMEMBERED = 400_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WholeTokens:
    """A vocabulary with the strings that are proven to encode alone as exactly one token.

    The proof is made once for each worker, by encoding every vocabulary string by itself and as a
    single pre-token: ``whole`` holds those for which both give one token. A pre-token found there
    counts one; any other one is merged by the vocabulary's own merges and remembered.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pieces = regex.compile(pattern)
        self.letters = byte_letters()
        byte_of = {c: b for b, c in self.letters.items()}
        strings = []
        for token in spec["model"]["vocab"]:
            try:
                strings.append(bytes(byte_of[c] for c in token).decode())
            except (KeyError, UnicodeDecodeError):  # a special string, or part of a character: never a pre-token
                continue
        alone = self.tokenizer.encode_batch(strings, add_special_tokens=False)
        self.whole = frozenset(s for s, e in zip(strings, alone) if len(e.ids) == 1 and self.pieces.fullmatch(s) and s not in added)
        self.merged: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        whole, merged, out, rest = self.whole, self.merged, [], []
        for text in texts:
            n, parts = 0, [text]
            if self.special and self.special.search(text):
                n, parts = len(self.special.findall(text)), self.special.split(text)
            odd = []
            for part in parts:
                pieces = self.pieces.findall(part)
                odd += [p for p in pieces if p not in whole]
                n += len(pieces)
            out.append(n - len(odd))
            rest.append(odd)
        new = list({p for odd in rest for p in odd}.difference(merged))
        if len(merged) + len(new) > REMEMBERED:
            merged.clear()
            new = list({p for odd in rest for p in odd})
        merge, letters = self.tokenizer.model.tokenize, self.letters
        for p in new:
            merged[p] = len(merge(p.encode().decode("latin1").translate(letters)))
        return [n + sum(map(merged.__getitem__, odd)) for n, odd in zip(out, rest)]


@lru_cache(maxsize=2)
def whole_tokens(path: str, pattern: str) -> WholeTokens:
    return WholeTokens(path, pattern)


def slices(texts: list[str], limit: int = 1 << 20):
    """Runs of texts of about ``limit`` characters, one long text alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield texts[start:]


def token_counts(docs: DataFrame, path: str, pattern: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` without ``text`` and with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    Texts are whole; a null text is empty and has none. Special strings inside a text count one token,
    the library's default. One pass without a shuffle; rows, repeats and other columns stay as they
    are, but for columns that have the three names, which are replaced.
    """
    new = ["n_bytes", "n_tokens"]
    kept = [c for c in docs.columns if c not in (text, *new, "over_limit")]

    def work(batches):
        for b in batches:
            texts, counts = b.column(b.num_columns - 1).to_pylist(), []
            for part in slices(texts):
                counts += whole_tokens(path, pattern).counts(part)
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), sizes, pa.array(counts, pa.int64())], names=[*inner, *new])

    inner = [f"c{i}" for i in range(len(kept))]
    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for n, c in zip(inner, kept)), *(T.StructField(c, T.LongType()) for c in new)])
    counted = docs.select(*(F.col(c).alias(n) for c, n in zip(kept, inner)), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(work, schema).toDF(*kept, *new)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
