"""Line dedup by winnowing over line hashes.

Lines with a word are hashed. Every stretch of lines that first reaches ``min_words`` words is
a window, taken forward and backward; the line with the smallest hash in it (the first of equals)
is selected. Of all windows that select a line one position is kept, with the hashes of the lines
that these windows span. So any passage of ``min_words`` words that two places share has a position
in common.

Positions are joined by hash with the first position of the same hash and compared line by line
outward, both ways: a run of equal lines of ``min_words`` words or more is a match, and the later
place is deleted. Windows that such a match does not cover stand, if they match at all, in places
that the first position does not match; they are joined once more, with the first place of the
whole window. A line is thus deleted exactly if it lies in a run of lines of ``min_words`` words or more,
the same as a run at an earlier place.

Places are ordered by id, then text, then line; NULL ids come first. The earliest place of a
line is never deleted, so every text survives somewhere. Lines without a word are neither
compared nor deleted; a document keeps its row even if all its lines go. NULL text stays NULL.
Rows equal in id and text are one document: they are judged once and get the same result.
Words are separated by blanks, tabs and line ends; lines end at a line feed.

Only whole lines are compared: a repeated passage that begins or ends inside a line is found as far
as its whole lines reach ``min_words`` words, and not at all below that.

Only built-in functions: no Python in the tasks. Lines are compared by a 64-bit and a 32-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import SPACED_WORD, count_words, counted_join, free_names, pick, words_of
from .registry import query


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: doc, line number, hashes, words in it.

    Copies of a row are combined in the tasks that read them, then once per document.
    """
    lines = F.transform(
        F.split("text", "\n"),
        lambda value, i: F.struct(
            i.alias("line"),
            F.xxhash64(value).alias("h"),
            F.hash(value).alias("g"),
            count_words(value, SPACED_WORD).cast("int").alias("words"),
        ),
    )
    texts = docs.select("doc_id", "th", F.filter(lines, lambda x: x["words"] > 0).alias("lines"))
    once = texts.where(F.size("lines") > 0).groupBy("doc_id", "th").agg(F.first("lines").alias("lines"))
    return once.select("doc_id", "th", F.inline("lines"))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """One row per window: selected line ``at``, its hash, lines before it (nearest first) and from it on.

    A window is given by where lines start or end in words: the lines that start less than
    ``min_words`` after the start of this one, or end less than that before its end.
    """
    doc = Window.partitionBy("doc_id", "th")
    # Ends and starts in words; every line has a word, so both grow from line to line.
    rows = lines.withColumn(
        "stop", F.sum("words").over(doc.orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("stop") - F.col("words"))
    ahead = doc.orderBy("start").rangeBetween(0, min_words - 1)
    back = doc.orderBy("stop").rangeBetween(-(min_words - 1), 0)
    item = F.struct("line", "h", "g", "words")
    rows = rows.withColumns(
        {
            "a": F.collect_list(item).over(ahead),
            "a_words": F.sum("words").over(ahead),
            "b": F.collect_list(item).over(back),
            "b_words": F.sum("words").over(back),
        }
    )
    # A window reached both ways is one.
    found = F.array(*[F.when(F.col(f"{s}_words") >= min_words, F.col(s)) for s in "ab"])
    found = F.array_distinct(F.filter(found, lambda x: x.isNotNull()))
    rows = rows.select("doc_id", "th", F.explode(found).alias("window"))
    rows = rows.withColumn("fp", F.array_min("window.h"))
    rows = rows.withColumn("pick", F.array_position("window.h", F.col("fp")).cast("int"))
    return rows.select(
        "doc_id", "th", F.element_at("window", F.col("pick"))["line"].alias("at"), "fp",
        F.reverse(F.slice("window", 1, F.col("pick") - 1)).alias("left"),
        F.slice("window", F.col("pick"), F.size("window")).alias("right"),
    )


def positions(lines: DataFrame, min_words: int) -> DataFrame:
    """The selected positions: what their windows span to the left and right, and each window's share."""
    return (
        _windows(lines, min_words)
        .groupBy("doc_id", "th", "at")
        .agg(
            F.first("fp").alias("fp"),
            F.max_by("left", F.size("left")).alias("left"),
            F.max_by("right", F.size("right")).alias("right"),
            F.collect_set(F.struct(F.size("left").alias("l"), F.size("right").alias("r"))).alias("spans"),
        )
    )


def _equal(mine: str, other: str) -> Column:
    """How many lines from the first on are the same in both arrays."""
    same = F.zip_with(
        mine, other, lambda x, y: x["h"].eqNullSafe(y["h"]) & x["g"].eqNullSafe(y["g"])
    )
    differ = F.array_position(same, F.lit(False)).cast("int")
    return F.when(differ > 0, differ - 1).otherwise(F.size(mine))


def _stretch(l: Column, r: Column) -> tuple[Column, Column]:
    """First and last line of ``l`` lines to the left of the position and ``r`` from it on."""
    first = F.when(l > 0, F.try_element_at("left", l)["line"]).otherwise(F.col("at"))
    return first.alias("first"), F.try_element_at("right", r)["line"].alias("last")


def _extended(later: DataFrame, min_words: int) -> DataFrame:
    """Per position the run it shares with the first of its hash, and the windows beyond that run."""
    rows = later.withColumns({"l": _equal("left", "o_left"), "r": _equal("right", "o_right")})
    shared = F.concat(F.slice("left", 1, F.col("l")), F.slice("right", 1, F.col("r")))
    words = F.aggregate(shared, F.lit(0), lambda total, x: total + x["words"])
    run = F.when((F.col("r") > 0) & (words >= min_words), F.struct(*_stretch(F.col("l"), F.col("r"))))

    def window(span):
        lines = F.concat(F.reverse(F.slice("left", 1, span["l"])), F.slice("right", 1, span["r"]))
        return F.struct(
            F.struct(
                F.xxhash64(F.transform(lines, lambda x: x["h"])).alias("w1"),
                F.xxhash64(F.transform(lines, lambda x: x["g"])).alias("w2"),
            ).alias("content"),
            *_stretch(span["l"], span["r"]),
        )

    beyond = F.filter("spans", lambda span: (span["l"] > F.col("l")) | (span["r"] > F.col("r")))
    return rows.select("doc_id", "th", run.alias("run"), F.transform(beyond, window).alias("rest"))


def deleted_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Per document (doc_id, th) the stretches of lines to delete; ``docs`` has text as well."""
    found = materialize(positions(_lines(docs), min_words), "line-positions")
    place = F.struct("doc_id", "th", "at")
    # Hashes that one position only has cannot match.
    shared = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("origin"))
    shared = materialize(shared.where("n > 1").withColumn("copies", F.col("n")), "line-prints")
    met = materialize(counted_join(found, shared, "fp", "n", place), "line-matches")
    is_first = place.eqNullSafe(F.col("origin"))
    firsts = met.where(is_first).select(
        "fp", F.col("copies").alias("n"), F.col("left").alias("o_left"), F.col("right").alias("o_right")
    )
    later = counted_join(met.where(~is_first).drop("origin", "copies"), firsts, "fp", "n", place)
    later = materialize(_extended(later, min_words), "line-runs")
    runs = later.where("run is not null").select("doc_id", "th", "run.first", "run.last")
    # What the first position of the hash does not share, by whole windows.
    rest = later.select("doc_id", "th", F.inline("rest"))
    start = F.struct("doc_id", "th", "first")
    heads = rest.groupBy("content").agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("origin"))
    heads = materialize(heads.where("n > 1"), "line-firsts")
    again = counted_join(rest, heads, "content", "n", start).where(~start.eqNullSafe(F.col("origin")))
    runs = runs.unionByName(again.select("doc_id", "th", "first", "last"))
    return runs.groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs")
    )


def dedup(
    docs: DataFrame,
    min_words: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    report: bool = True,
) -> DataFrame:
    """``docs``, all columns, with the later copies of repeated runs cut out of the text.

    With ``report`` three columns are added: ``dedup_lines`` (lines deleted), ``dedup_words``
    (words deleted) and ``dedup_runs`` (stretches of line numbers, from 0). Where the table
    has such a column, the new one gets an underscore in front.
    """
    n_lines, n_words, stretches, id_, th, runs_ = free_names(
        docs, "dedup_lines", "dedup_words", "dedup_runs", "_id", "_th", "_runs"
    )
    texts = pick(docs, doc_id=id_column, text=text_column).where(F.col("text").isNotNull())
    texts = texts.select("doc_id", F.xxhash64("text").alias("th"), "text")
    runs = deleted_lines(texts, min_words)
    # Overlapping stretches are merged, so each line is looked up among few.
    merged = F.expr("""
        aggregate(runs, cast(array() as array<struct<first: int, last: int>>), (a, x) ->
          case when size(a) > 0 and element_at(a, -1).last >= x.first - 1
          then concat(slice(a, 1, size(a) - 1), array(named_struct(
            'first', element_at(a, -1).first, 'last', greatest(element_at(a, -1).last, x.last))))
          else concat(a, array(x)) end)
    """)
    runs = runs.select(F.col("doc_id").alias(id_), F.col("th").alias(th), merged.alias(runs_))
    text = F.col(f"`{text_column}`")
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(th))
    marked = docs.join(runs.hint("shuffle_hash"), same, "left").drop(id_, th)

    def goes(line, i):
        inside = F.exists(runs_, lambda r: (r["first"] <= i) & (i <= r["last"]))
        return inside & F.rlike(line, F.lit(SPACED_WORD))

    lines, cut = F.split(text, "\n"), F.col(runs_).isNotNull()
    left = F.array_join(F.filter(lines, lambda x, i: ~goes(x, i)), "\n")
    columns = [
        F.when(cut, left).otherwise(text).alias(c) if c == text_column else F.col(f"`{c}`")
        for c in docs.columns
    ]
    if not report:
        return marked.select(*columns)
    gone = F.filter(lines, goes)
    gone_words = F.size(words_of(F.array_join(gone, " "), SPACED_WORD))
    none = F.array().cast("array<struct<first: int, last: int>>")
    return marked.select(
        *columns,
        F.when(cut, F.size(gone)).otherwise(0).cast("long").alias(n_lines),
        F.when(cut, gone_words).otherwise(0).cast("long").alias(n_words),
        F.coalesce(runs_, none).alias(stretches),
    )


@query(
    "op7_line_dedup",
    sql=r"""
with d as (select distinct doc_id, text from documents where text is not null),
raw as (
  select doc_id, text, i - 1 as line, string_split(text, chr(10))[i] as value
  from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from d)
),
l as (
  select *, len(regexp_extract_all(value, '[^\x20\x09-\x0D]+')) as words
  from raw where regexp_matches(value, '[^\x20\x09-\x0D]')
),
p as (
  select *, sum(words) over (partition by doc_id, text order by line) as stop from l
),
q as (select *, stop - words as start from p),
w as (
  select doc_id, text, line as first, max(line) over a as last,
    string_agg(value, chr(10)) over a as content, sum(words) over a as n
  from q window a as (partition by doc_id, text order by start range between 0 preceding and 49 following)
  union
  select doc_id, text, min(line) over b, line, string_agg(value, chr(10)) over b, sum(words) over b
  from q window b as (partition by doc_id, text order by stop range between 49 preceding and 0 following)
),
o as (
  select *, row_number() over (partition by content order by doc_id nulls first, first) as place
  from w where n >= 50
),
gone as (
  select distinct l.doc_id, l.text, l.line, l.words from o join l
  on l.doc_id is not distinct from o.doc_id and l.text = o.text
    and l.line between o.first and o.last
  where place > 1
),
cut as (
  select r.doc_id, r.text, string_agg(r.value, chr(10) order by r.line) filter (g.line is null) as kept,
    count(g.line) as n, coalesce(sum(g.words), 0) as words
  from raw r left join gone g on r.doc_id is not distinct from g.doc_id and r.text = g.text and r.line = g.line
  group by r.doc_id, r.text
)
select x.doc_id, case when x.text is null then null else coalesce(c.kept, '') end as text,
  cast(coalesce(n, 0) as bigint) as n_deleted_lines, cast(coalesce(words, 0) as bigint) as n_deleted_words
from documents x left join cut c on x.doc_id is not distinct from c.doc_id and x.text = c.text
""",
)
def op7_line_dedup(load) -> DataFrame:
    """Every document with its text after the cut; runs of 50 words or more."""
    cut = dedup(load("documents"))
    return cut.select(
        "doc_id", "text",
        F.col("dedup_lines").alias("n_deleted_lines"), F.col("dedup_words").alias("n_deleted_words"),
    )
