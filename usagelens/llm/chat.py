"""Chat formatting of preference pairs. DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common turn prefix is rendered once, as the prompt; what is left
of each is a completion with a mask: spans of characters that are trained on (assistant turns with their end mark), others not.

Defined cases: turns are ordered by (turn, role, text), repeated rows stay; null role reads as `user`, null text as empty; a
null conv_id is in no pair; conversations that are equal, or of which one begins the other, give an empty completion; an empty
table gives no rows; texts of any length are rendered whole; clashing or extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

TRAINED = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): an array of (role, text) by turn."""
    one = F.struct(F.col("turn").cast("long").alias("turn"), F.lower(F.coalesce("role", F.lit("user"))).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _turn(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def spans(turns: Column) -> Column:
    """(start, length, trained) for each turn's head and body in the rendered text, in characters."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int,trained:boolean>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        head, body = F.length(x["role"]) + 5, F.length(x["text"]) + 8
        trained = x["role"] == TRAINED
        parts = F.array(
            F.struct(acc["at"].alias("start"), head.alias("length"), F.lit(False).alias("trained")),
            F.struct((acc["at"] + head).alias("start"), body.alias("length"), trained.alias("trained")),
        )
        return F.struct((acc["at"] + head + body).alias("at"), F.concat(acc["out"], parts).alias("out"))

    return F.aggregate(turns, start, add, lambda acc: acc["out"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """`pairs`: (chosen_id, chosen, rejected_id, rejected), turns as arrays. Gives prompt, completions and masks."""
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    broken = F.array_position(same, F.lit(False)).cast("int")
    shared = F.when(broken > 0, broken - 1).otherwise(F.least(F.size("chosen"), F.size("rejected")))
    df = pairs.withColumn("n_shared", shared)
    rest = lambda c: F.slice(F.col(c), F.col("n_shared") + 1, F.greatest(F.size(c) - F.col("n_shared"), F.lit(0)))
    return df.select(
        "chosen_id", "rejected_id", F.col("n_shared").cast("long").alias("n_prompt_turns"),
        render(F.slice("chosen", F.lit(1), F.col("n_shared"))).alias("prompt"),
        render(rest("chosen")).alias("chosen"), spans(rest("chosen")).alias("chosen_mask"),
        render(rest("rejected")).alias("rejected"), spans(rest("rejected")).alias("rejected_mask"),
    )


def opened(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, opening, chosen_id): `opening` names the first role and text, chosen_id is the smallest conv_id that opens so. Staged: built once."""
    all_ = conversations(turns)
    all_ = staged(all_.withColumn("opening", F.sha2(F.concat_ws("\x00", F.element_at("turns", 1)["role"], F.element_at("turns", 1)["text"]), 256)), "conversations")
    first = staged(all_.groupBy("opening").agg(F.min("conv_id").alias("chosen_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "openings")
    return all_.join(first, "opening", "left")


def by_first_turn(turns: DataFrame, salts: int = 32) -> DataFrame:
    """Pairs from conversations that open alike (same first role and text): the one of the smallest conv_id is the chosen of each other.

    n conversations give n - 1 pairs. The chosen of every opening is dealt to all salts, so the others of one opening are spread.
    """
    return _paired(opened(turns), salts)


def _paired(all_: DataFrame, salts: int) -> DataFrame:
    first = all_.where("conv_id = chosen_id").select("chosen_id", F.col("turns").alias("chosen"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    other = all_.where("conv_id > chosen_id").select("chosen_id", F.pmod(F.xxhash64("conv_id"), F.lit(salts)).alias("salt"), F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    return other.join(first, ["chosen_id", "salt"]).select("chosen_id", "chosen", "rejected_id", "rejected")


def format_chat(turns: DataFrame, salts: int = 32) -> DataFrame:
    """Every conversation's row: (conv_id, chosen_id or null, prompt, chosen, rejected, masks, counts).

    A conversation that opens like an earlier one is the rejected of its pair. All others are rendered alone: the prompt is
    what comes before the last assistant turn, the completion the rest.
    """
    all_ = opened(turns)
    pairs = format_pairs(_paired(all_, salts))
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda x: x["role"])), F.lit(TRAINED)).cast("int")
    has = F.array_contains(F.transform("turns", lambda x: x["role"]), TRAINED)
    cut = F.when(has, last).otherwise(F.size("turns"))
    alone = all_.where("chosen_id IS NULL OR conv_id = chosen_id").withColumn("_cut", cut)
    rest = F.slice("turns", F.col("_cut") + 1, F.greatest(F.size("turns") - F.col("_cut"), F.lit(0)))
    none = F.array().cast("array<struct<start:int,length:int,trained:boolean>>")
    alone = alone.select(
        "conv_id", F.lit(None).cast(turns.schema["conv_id"].dataType).alias("chosen_id"), F.col("_cut").cast("long").alias("n_prompt_turns"),
        render(F.slice("turns", F.lit(1), F.col("_cut"))).alias("prompt"), render(rest).alias("chosen"), spans(rest).alias("chosen_mask"),
        F.lit(None).cast("string").alias("rejected"), none.alias("rejected_mask"),
    )
    pairs = pairs.select(F.col("rejected_id").alias("conv_id"), "chosen_id", "n_prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")
    return pairs.unionByName(alone)


def trained_chars(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + F.when(x["trained"], x["length"]).otherwise(0))


def digest(turns: DataFrame) -> DataFrame:
    """format_chat() with digests for the texts and sums for the masks."""
    return format_chat(turns).select(
        "conv_id", "chosen_id", "n_prompt_turns", F.sha2("prompt", 256).alias("prompt_sha256"), F.sha2("chosen", 256).alias("chosen_sha256"),
        F.sha2("rejected", 256).alias("rejected_sha256"), trained_chars(F.col("chosen_mask")).alias("chosen_trained"), trained_chars(F.col("rejected_mask")).alias("rejected_trained"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, list(struct_pack(role := lower(coalesce(role, 'user')), text := coalesce(text, '')) ORDER BY turn, lower(coalesce(role, 'user')), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
o AS (SELECT conv_id, t, min(conv_id) OVER (PARTITION BY t[1].role, t[1].text) AS c FROM t),
p AS (
  SELECT r.conv_id, k.conv_id AS chosen_id, k.t AS c, r.t AS r,
    coalesce(list_min(list_filter(range(1, least(len(k.t), len(r.t)) + 1), lambda i: k.t[i] <> r.t[i])) - 1, least(len(k.t), len(r.t))) AS n
  FROM o r JOIN t k ON k.conv_id = r.c WHERE r.conv_id <> r.c
  UNION ALL
  SELECT conv_id, NULL, t, NULL, coalesce(list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) - 1, len(t)) FROM o WHERE conv_id = c)
SELECT conv_id, chosen_id, CAST(n AS BIGINT) AS n_prompt_turns,
  sha256(array_to_string(list_transform(c[1:n], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '')) AS prompt_sha256,
  sha256(array_to_string(list_transform(c[n + 1:], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '')) AS chosen_sha256,
  CASE WHEN r IS NOT NULL THEN sha256(array_to_string(list_transform(r[n + 1:], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '')) END AS rejected_sha256,
  CAST(coalesce(list_sum(list_transform(c[n + 1:], lambda x: CASE WHEN x.role = 'assistant' THEN length(x.text) + 8 ELSE 0 END)), 0) AS BIGINT) AS chosen_trained,
  CAST(coalesce(list_sum(list_transform(r[n + 1:], lambda x: CASE WHEN x.role = 'assistant' THEN length(x.text) + 8 ELSE 0 END)), 0) AS BIGINT) AS rejected_trained
FROM p
"""
