"""Chat formatting: cumulative snapshots of a conversation collapse to the longest before rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def turn_prefixes(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, rank, n_turns, prefix): for each turn a hash of the conversation up to it, itself included.

    The hash rolls over the turns in their order (ties by role, then text): the running exclusive-or of
    two 64-bit hashes of rank, role and text, so a long conversation costs one step for each turn.
    """
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).where("conv is not null")
    parts = ["rank", F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("rank", F.row_number().over(order)).select(
        "conv", "rank", F.count("*").over(Window.partitionBy("conv")).alias("n_turns"),
        F.struct(*(F.bit_xor(F.xxhash64(F.lit(salt), *parts)).over(running).alias(f"h{salt}") for salt in (1, 2))).alias("prefix"))


def formatted(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    template: str = "<|{role}|>\n{text}\n",
) -> DataFrame:
    """(conversation, n_turns, n_snapshots, text): each maximal conversation, rendered.

    A conversation that equals the first turns of a longer one is a logged snapshot of it and goes (an
    anti-join of whole hashes with proper prefixes); of equal conversations the one with the smallest id
    stays. ``n_snapshots`` counts the conversations, itself included, that collapsed into one that is
    kept as its prefixes. Turns are in turn order, ties by role and text. A null role or text is compared
    as a value of its own and rendered empty. Rows with a null conversation go. Other columns are ignored.
    """
    prefixes = turn_prefixes(turns, conversation, turn, role, text)
    whole = prefixes.where("rank = n_turns").groupBy("prefix").agg(F.min("conv").alias("conv"), F.max("n_turns").alias("n_turns"), F.count("*").alias("copies"))
    proper = prefixes.where("rank < n_turns").select("prefix").distinct()
    kept = whole.join(proper, "prefix", "left_anti")
    inside = prefixes.join(kept.select("conv"), "conv", "left_semi").join(whole.select("prefix", "copies"), "prefix")
    snapshots = inside.groupBy("conv").agg(F.sum("copies").alias("n_snapshots"))
    before, middle, after = template.replace("{role}", "\x01").replace("{text}", "\x01").split("\x01")
    shown = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(middle), F.coalesce("text", F.lit("")), F.lit(after))
    rows = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rendered = (
        rows.join(kept.select("conv", "n_turns"), "conv")
        .groupBy("conv", "n_turns")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text", shown.alias("shown")))).alias("rows"))
        .select("conv", "n_turns", F.array_join("rows.shown", "").alias("rendered"))
    )
    return rendered.join(snapshots, "conv").select(
        F.col("conv").alias(conversation), F.col("n_turns").cast("long").alias("n_turns"), F.col("n_snapshots").cast("long").alias("n_snapshots"), F.col("rendered").alias("text"))


#: The same in DuckDB: prefixes are compared as lists of turns.
SQL = """
with rows as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls last, role nulls first, text nulls first) k from conversations where conv_id is not null),
pre as (select conv_id, k, count(*) over (partition by conv_id) n,
  sha256(array_to_string(list(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n')) over (partition by conv_id order by k), chr(2))) p from rows),
whole as (select p, min(conv_id) conv_id, max(n) n, count(*) copies from pre where k = n group by p),
kept as (select * from whole where p not in (select p from pre where k < n)),
snap as (select pre.conv_id, sum(whole.copies) s from pre join kept on pre.conv_id = kept.conv_id join whole on whole.p = pre.p group by pre.conv_id)
select r.conv_id, kept.n::bigint as n_turns, snap.s::bigint as n_snapshots,
  string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' order by r.k) as text
from rows r join kept using (conv_id) join snap using (conv_id) group by 1, 2, 3
"""
