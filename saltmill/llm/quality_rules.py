"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and, in one long,
a bit per failed rule. Policies are versioned masks: what a version keeps, and what each of
its rules costs, follow from the bits without reading a text again.

NULL text has no words and measures 0 everywhere; it fails ``few_words``. Repeated rows are judged
one by one. An empty table gives an empty ledger. Columns other than id and text are not read.
All work is done by built-in functions on the rows themselves: no shuffle, no group. Repeated
windows are found by 64-bit hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACED_WORD, count_words, pick
from .registry import query

# Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

# Measurements of a text, given as SQL over ``text`` (not NULL) and its words ``w``.
# Windows: hash and place of each 3-word window, sorted; equal neighbours are repeats, and
# each repeat adds the words that the one before it did not cover.
_HASHES = "transform(sequence(0, size(w) - 3), i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) as h, i as i))"
_REPEATS = """
array_sort(transform(filter(s, (x, k) ->
  (k > 0 and s[greatest(k - 1, 0)].h = x.h) or (k < size(s) - 1 and s[least(k + 1, size(s) - 1)].h = x.h)
), x -> x.i))
"""
_COVERED = """
aggregate(r, named_struct('n', 0L, 'to', 0), (a, i) -> named_struct(
  'n', a.n + i + 3 - greatest(i, a.to), 'to', i + 3), a -> a.n)
"""


def _let(name: str, value: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it under a name."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeat_words() -> str:
    covered = _let("r", _REPEATS, _COVERED)
    return f"case when size(w) < 4 then 0L else {_let('s', f'sort_array({_HASHES})', covered)} end"


MEASURES = {
    "n_words": "cast(size(w) as bigint)",
    "word_chars": "cast(char_length(array_join(w, '')) as bigint)",
    "n_repeat_words": _repeat_words(),
}
LINE_MEASURES = {
    "n_lines": "cast(size(l) as bigint)",
    "n_dup_lines": "cast(size(l) - size(array_distinct(l)) as bigint)",
}


@dataclass(frozen=True)
class Rule:
    """A document fails if ``fails`` (SQL over measurements) holds."""

    name: str
    fails: str


# The place in this list is the bit: rules are only ever added at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "n_words > 0 and word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("capitals", "100 * n_capitals > 50 * word_chars"),
)
BASE = ("few_words", "repeated_windows")
# Versions stay as they were published.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines", "short_words", "long_words", "capitals"),
}


def mask_of(names: tuple[str, ...] | list[str]) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(bits[n] for n in names)


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, measurements, and ``failed``, a bit per rule in the order of RULES."""
    rows = pick(docs, doc_id=id_column, text=text_column).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    pattern = SPACED_WORD.replace("\\", "\\\\")
    words = f"regexp_extract_all(text, '{pattern}', 0)"
    lines = f"filter(split(text, '\\n'), x -> x rlike '{pattern}')"

    def struct(measures):
        return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in measures.items()) + ")"

    measured = rows.select(
        "doc_id",
        F.expr(_let("w", words, struct(MEASURES))).alias("a"),
        F.expr(_let("l", lines, struct(LINE_MEASURES))).alias("b"),
        count_words(F.col("text"), SYMBOLS).alias("n_symbols"),
        count_words(F.col("text"), "[A-Z]").alias("n_capitals"),
    ).select("doc_id", "a.*", "b.*", "n_symbols", "n_capitals")
    failed = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed", failed)


def passes(failed: Column, names: tuple[str, ...] | list[str]) -> Column:
    return failed.bitwiseAND(F.lit(mask_of(names)).cast("long")) == 0


def apply_policy(entries: DataFrame, version: int) -> DataFrame:
    """The ledger with a column ``kept`` for a version of the policy."""
    return entries.withColumn("kept", passes(F.col("failed"), POLICIES[version]))


def ablation(entries: DataFrame, version: int) -> DataFrame:
    """Per rule of a version: documents failing it, failing only it, and kept without it.

    The ledger is cut to counts per bit pattern first, of which there are few.
    """
    patterns = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    names = POLICIES[version]
    whole = mask_of(names)
    rules = F.explode(
        F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask_of([n])).cast("long").alias("bit")) for n in names])
    )
    kept = F.col("failed").bitwiseAND(F.lit(whole).cast("long"))
    fails = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.withColumn("r", rules)
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(kept == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(
                F.when(kept.bitwiseAND(F.bitwise_not("r.bit")) == 0, F.col("n")).otherwise(0)
            ).alias("n_kept_without"),
        )
    )


@query(
    "op4_quality_rules",
    sql=r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from d),
g as (
  select r, i, hash(w[i]) as h, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 3)
),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
covered as (
  select r, count(distinct i + k) as n_repeat_words
  from again, (select unnest([0, 1, 2]) as k) group by r
),
l as (
  select r, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines
  from (select r, unnest(string_split(text, chr(10))) as l from d)
  where regexp_matches(l, '[^\x20\x09-\x0D]') group by r
),
m as (
  select doc_id, len(w) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_capitals,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from w left join covered using (r) left join l using (r)
),
f as (
  select *,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    (case when n_words < 50 then 1 else 0 end)
    + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
    + (case when 100 * n_symbols > 30 * n_words then 4 else 0 end)
    + (case when n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines then 8 else 0 end)
    + (case when n_words > 0 and word_chars < 2 * n_words then 16 else 0 end)
    + (case when word_chars > 15 * n_words then 32 else 0 end)
    + (case when 100 * n_capitals > 50 * word_chars then 64 else 0 end) as failed
  from m
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed, failed = 0 as kept,
  cast(failed as bigint) as failed
from f
""",
)
def op4_quality_rules(load) -> DataFrame:
    """Every document under version 2 of the policy, which holds the base rules."""
    entries = apply_policy(ledger(load("documents")), 2)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(F.col("failed"), BASE)).alias("base_failed"), "kept", "failed",
    )
