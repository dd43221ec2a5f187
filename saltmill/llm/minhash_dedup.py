"""MinHash near-dedup.

A document's set is its distinct shingles of ``words`` words; documents with equal sets are one
class. Classes get ``bands * rows`` minima under universal hash functions; classes that agree
on a band meet in a bucket. Candidates are compared by their signatures (one byte per minimum,
rejected only far below the threshold), then linked if the full sets say so. Links become
components by large-star and small-star.

No bucket is turned into all its pairs. Members are first compared with two hubs of their
bucket; those that are not yet in the component of a third hub with that one; in the end
members of one bucket in different components are compared, so no link between components
is lost. Buckets with few members left are joined by their key. Members of larger ones meet
only if they share one of their rarest shingles (a prefix filter): of sets of n and m shingles
at least 3 (n + m) / 7 must be common, so the n - 3 (n + m) / 7 + 1 rarest of one and the
rarest of the other cannot all differ. Sizes lie in bands a twentieth wide, and a set gives one
prefix per band of partners, since m decides its length. Documents that share a boilerplate
but stay below the threshold hold more shingles of their own than a prefix has, so they do not
meet at all. Members of one component are not paired.

Pairs are written between the joins that find, thin and compare them: all broadcasts and shuffles of
one plan are held by the driver at once, however few rows they have.

Pairs leave the joins only if their parity bitmaps allow the similarity: bit i is
the parity of the number of shingles with hash i modulo 1024, so the bits in which two
documents differ are at most the shingles in which they differ. That bound is exact, and
leaves out nearly all pairs below the threshold before anything is fetched for them.

With the parameters given, two documents at the threshold share no bucket with probability
(1 - 0.75 ** 4) ** 32, about 5 in a million, more similar ones less; a pair that is linked is
rejected by its signatures at most once in ten billion.

Documents without words, or NULL, have an empty set and no links. Rows equal in id and text are
members of one class like other copies. A component is named by its smallest id (NULL ids
count only if there is no other); a NULL id without partners names itself. Other columns are
not read. An empty table gives an empty result. Shingles are 64-bit hashes of 64-bit word
hashes; classes are 64-bit hashes of the sorted set.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import OrderedDict
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import counted_join, free_names, map_rows, pick
from .components import components, extended
from .registry import query

WORDS = 5
BANDS, ROWS = 32, 4
PERCENT = 75
# Words of 64 bits in a parity bitmap.
BITMAP = 16
# The same, folded to so many.
FOLDED = 4
# Estimates below this are rejected without the sets: more than six deviations under 0.75.
LEAST_ESTIMATE = 0.5
# Buckets with at most this many members left are joined by key, larger ones by rare shingles.
PAIRED = 32
# At most so many of the most frequent shingles of large buckets are ordered by a list, not by a join.
LISTED = 1_000
# The list is made from about so many shingles of members, chosen by hash.
SAMPLED = 20_000
# Members of a key meet at once if they have at most so many pairs, and so many per pair of two components.
AT_ONCE, AT_ONCE_SHARE = 4_000_000, 32
# A size band ends where the size has grown by this factor.
GROWTH = 1.05
# A task remembers the hashes of this many words, and the sets of this many classes.
MEMORY = 500_000
SETS = 32

_U = np.uint64


def _band_edges(most: int = 2**31) -> list[int]:
    edges = [1]
    while edges[-1] < most:
        edges.append(max(edges[-1] + 1, int(edges[-1] * GROWTH)))
    return edges


# The least size of every band.
EDGES = _band_edges()


def _band(n: int) -> int:
    return bisect_right(EDGES, n) - 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingles(text: str | None, hashes: _WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; A-Z count as lower case, words end at ASCII blanks."""
    # bytes.lower and bytes.split touch ASCII letters and ASCII blanks only.
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), dtype=np.uint64, count=len(parts))
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = _mixed(out * _U(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


class _Hashing:
    """Universal functions a * x + b of the upper half of a shingle hash, modulo 2 ** 64."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20)
        n = bands * rows
        self.bands, self.rows, self.words = bands, rows, _WordHashes()
        self.a = rng.integers(1, 2**64, n, dtype=np.uint64)[:, None] | _U(1)
        self.b = rng.integers(0, 2**64, n, dtype=np.uint64)[:, None]

    def minima(self, found: np.ndarray) -> np.ndarray:
        x = found >> _U(32)
        least = np.full(len(self.a), 2**64 - 1, dtype=np.uint64)
        for at in range(0, len(x), 1024):
            values = self.a * x[None, at : at + 1024]
            values += self.b
            np.minimum(least, values.min(axis=1), out=least)
        return least >> _U(24)

    def keys(self, minima: np.ndarray) -> np.ndarray:
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        grid = minima.reshape(self.bands, self.rows)
        for i in range(self.rows):
            out = _mixed(out * _U(0x9E3779B97F4A7C15) + grid[:, i])
        return out.view(np.int64)


def _parities(found: np.ndarray) -> np.ndarray:
    bits = np.bincount((found % _U(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sign(tool: _Hashing, doc_id, th, text):
    found = shingles(text, tool.words)
    if not len(found):
        return doc_id, th, 0, None, [], [], b""
    name = np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64)
    minima = tool.minima(found)
    return (
        doc_id,
        th,
        len(found),
        int(name),
        tool.keys(minima),
        _parities(found),
        (minima & _U(0xFF)).astype(np.uint8).tobytes(),
    )


def sign(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, text hash, set size n, class, band keys, parity bitmap and signature."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    kind = dict(rows.dtypes)["doc_id"]
    signed = map_rows(
        rows.select(F.col("doc_id").cast("string"), F.xxhash64("text").alias("th"), "text"),
        _sign,
        "doc_id string, th bigint, n bigint, class bigint, keys array<bigint>, "
        "bits array<bigint>, signature binary",
        setup=lambda: _Hashing(BANDS, ROWS),
    )
    return signed.withColumn("doc_id", F.col("doc_id").cast(kind))


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _folded(bits: Column) -> Column:
    """The parity bitmap of the hashes modulo 64 * FOLDED: as exact, shorter and weaker."""
    return F.array(
        *[reduce(Column.bitwiseXOR, [F.get(bits, F.lit(i)) for i in range(at, BITMAP, FOLDED)]) for at in range(FOLDED)]
    )


def _bits_fit(n: Column, bits: Column, m: Column, others: Column, words: int = BITMAP) -> Column:
    """False only if the sets differ in too many shingles to be linked."""
    differ = sum(
        (F.bit_count(F.get(bits, F.lit(i)).bitwiseXOR(F.get(others, F.lit(i)))) for i in range(words)),
        F.lit(0),
    )
    # 100 I >= P U for the intersection I and union U, with n + m = 2 I + differing shingles.
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (n + m)


def _linked(memory, a, b, sa, sb, ta, tb):
    """(a, b, linked): signatures first, then the full sets."""
    same = np.frombuffer(sa, dtype=np.uint8) == np.frombuffer(sb, dtype=np.uint8)
    if same.mean() < LEAST_ESTIMATE:
        return a, b, False
    words, sets = memory

    def of(name, text):
        if name not in sets:
            sets[name] = shingles(text, words)
            if len(sets) > SETS:
                sets.popitem(last=False)
        sets.move_to_end(name)
        return sets[name]

    x, y = of(a, ta), of(b, tb)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return a, b, 100 * both >= PERCENT * (len(x) + len(y) - both)


def verify(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """The pairs (a, b) of a written table that are linked; ``sets`` has class, signature and text."""
    a = sets.select(F.col("class").alias("a"), F.col("signature").alias("sa"), F.col("text").alias("ta"))
    b = sets.select(F.col("class").alias("b"), F.col("signature").alias("sb"), F.col("text").alias("tb"))
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb", "ta", "tb")
    links = map_rows(
        rows,
        _linked,
        "a bigint, b bigint, good boolean",
        setup=lambda: (_WordHashes(), OrderedDict()),
    )
    links = links.where("good").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return materialize(links, f"{label}-links")


def _hub_pairs(members: DataFrame, hubs: list[Column], sides: DataFrame) -> DataFrame:
    """Distinct pairs of members and hubs of their bucket (structs of class and n) that may be
    linked; ``sides`` has class, n and bits."""
    pairs = members.withColumn("hub", F.explode(F.array(*hubs))).where(
        (F.col("hub.class") != F.col("class")) & _sizes_fit(F.col("n"), F.col("hub.n"))
    )
    pairs = pairs.select(
        F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b")
    )
    return _allowed(materialize(pairs.distinct(), "dedup-met-hubs"), sides)


def _allowed(pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parity bitmaps allow a link, as a written table."""
    a = sides.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    b = sides.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    fits = _bits_fit(F.col("na"), F.col("ba"), F.col("nb"), F.col("bb"))
    return materialize(pairs.join(a, "a").join(b, "b").where(fits).select("a", "b"), "dedup-allowed")


def find_links(signed: DataFrame, docs: DataFrame, id_column: str, text_column: str):
    """(classes, links, roots): ``links`` joins every component, ``roots`` names them."""
    classes = materialize(
        signed.where("n > 0")
        .groupBy("class")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "th")).alias("first"),
            F.min("doc_id").alias("least_id"),
            *[F.first(c).alias(c) for c in ("n", "keys", "bits", "signature")],
        ),
        "dedup-classes",
    )
    rows = classes.select("class", "n", F.explode("keys").alias("key"))
    me = F.struct("class", "n")
    buckets = rows.groupBy("key").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    # Class names are hashes, so the least and the greatest are chance members.
    buckets = materialize(buckets.where("low.class <> high.class"), "dedup-buckets")
    members = materialize(rows.join(buckets, "key"), "dedup-members")
    named = members.select("class").distinct().join(classes, "class")
    named = named.select(
        "class", "n", "bits", "signature", F.col("first.doc_id").alias("id"), F.col("first.th").alias("th")
    )
    texts = pick(docs, id=id_column, text=text_column).withColumn("th", F.xxhash64("text"))
    same = texts["id"].eqNullSafe(named["id"]) & (texts["th"] == named["th"])
    found = texts.join(named.hint("shuffle_hash"), same).select(
        "class", "n", "bits", "signature", texts["text"]
    )
    sets = materialize(found.dropDuplicates(["class"]), "dedup-sets")

    hubs = [F.struct("low.class", "low.n"), F.struct("high.class", "high.n")]
    links = verify(_hub_pairs(members, hubs, sets), sets, "dedup-hubs")
    roots = components(links)
    members = members.select("key", "class", "n")
    for find in (_third_hub_pairs, _last_pairs):
        members = _mixed_members(members, roots)
        more = verify(find(members, sets), sets, "dedup-more")
        if not more.isEmpty():
            links = links.union(more)
            roots = extended(roots, more)
    return classes, links, roots


def _mixed_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their roots."""
    named = members.select("key", "class", "n").join(
        roots.withColumnRenamed("node", "class"), "class", "left"
    )
    named = materialize(
        named.select("key", "class", "n", F.coalesce("root", "class").alias("root")), "dedup-named"
    )
    mixed = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    mixed = materialize(mixed.select("key"), "dedup-mixed")
    return materialize(named.join(mixed, "key"), "dedup-left")


def _third_hub_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Another hub per bucket, by a new order; only members of other components are compared."""
    me = F.struct(F.xxhash64(F.lit(3), "class").alias("order"), "class", "n", "root")
    hubs = materialize(members.groupBy("key").agg(F.min(me).alias("third")), "dedup-third")
    others = members.join(hubs, "key").where("root <> third.root")
    return _hub_pairs(others, [F.struct("third.class", "third.n")], sets)


def _last_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of members of one bucket that no link has brought together so far."""
    held = members.groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    held = materialize(held, "dedup-held")
    few = members.join(held.where(F.col("held") <= PAIRED).select("key"), "key")
    many = members.join(held.where(F.col("held") > PAIRED).select("key"), "key")
    many = materialize(many.select("class", "n", "root").distinct(), "dedup-many")
    pairs = _bucket_pairs(few, sets)
    if many.isEmpty():
        return pairs
    return materialize(pairs.union(_rare_pairs(many, sets)).distinct(), "dedup-last-pairs")


def _bucket_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs within buckets of at most ``PAIRED`` members: at most that many per member."""
    members = materialize(members.join(sets.select("class", "bits"), "class"), "dedup-last")
    other = members.select(
        "key",
        F.col("class").alias("other"),
        F.col("n").alias("m"),
        F.col("root").alias("other_root"),
        F.col("bits").alias("other_bits"),
    )
    pairs = members.join(other, "key").where(
        (F.col("class") < F.col("other"))
        & (F.col("root") != F.col("other_root"))
        & _sizes_fit(F.col("n"), F.col("m"))
        & _bits_fit(F.col("n"), F.col("bits"), F.col("m"), F.col("other_bits"))
    )
    pairs = pairs.select(F.col("class").alias("a"), F.col("other").alias("b")).distinct()
    return materialize(pairs, "dedup-met-few")


def _shingles_of(words, name, text):
    return name, shingles(text, words).view(np.int64).tolist()


def _prefixes(places, name, n, root, rare, frequent):
    """Keys of the rarest shingles, as the smaller and as the larger of a pair.

    ``rare`` has the shingles that other members hold as well, rarest first, and ``frequent`` those
    of the list, which come after them in the order of ``places``; the others of the ``n`` come
    before both and can match nothing, so they only use up the prefix.
    """
    rare = [*(rare or ()), *sorted(frequent, key=places.__getitem__)]
    tokens = np.array(rare, dtype=np.int64).view(np.uint64)
    own, band, least = n - len(tokens), _band(n), -(-PERCENT * n // 100)

    def keys(partners, pair):
        out = [np.empty(0, dtype=np.uint64)]
        for other in partners:
            common = -(-PERCENT * (n + max(EDGES[other], least)) // (100 + PERCENT))
            low, high = pair(other)
            length = n - common + 1 - own
            if length > 0:
                out.append(_mixed(tokens[:length] * _U(0x9E3779B97F4A7C15) + _U(low << 32 | high)))
        return np.concatenate(out).view(np.int64).tolist()

    smaller = keys(range(band, _band(100 * n // PERCENT) + 1), lambda other: (band, other))
    larger = keys(range(_band(least), band + 1), lambda other: (other, band))
    return name, n, root, smaller, larger


def _listed(held: DataFrame) -> dict[int, int]:
    """The most frequent shingles of the members, each with its place, rarest first.

    The shingles of a large group are few and stand at the end of every order; as a list they order
    nearly all that the group has without a row for each. They are looked for among every so-manyth
    shingle of every member, about ``SAMPLED`` in all. That decides the list only, and with any
    list the same members meet: prefixes need one order, and all other shingles are counted in full.
    """
    total = held.agg(F.sum(F.size("tokens"))).first()[0] or 0
    step = max(1, total // SAMPLED)
    some = F.filter("tokens", lambda t: F.pmod(F.xxhash64("class", t), F.lit(step)) == 0)
    counts = held.select(F.explode(some).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    bar = max(2, total // step // LISTED + 1)
    found = counts.where(F.col("held") >= bar).orderBy(F.desc("held"), "token").limit(LISTED).collect()
    return {r["token"]: i for i, r in enumerate(reversed(found))}


def _rare_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of members (class, n, root) of different roots that may be linked, by prefixes."""
    texts = members.join(sets.select("class", "text"), "class").select("class", "text")
    held = map_rows(
        texts, _shingles_of, "class bigint, tokens array<bigint>", setup=_WordHashes
    )
    held = materialize(held, "dedup-shingles")
    places = _listed(held)
    # Only the shingles off the list become rows, once, to be counted and joined.
    others = held.select("class", F.explode(F.filter("tokens", lambda t: ~t.isin(*places))).alias("token"))
    others = materialize(others, "dedup-others")
    # A shingle that one member only has is in no pair, so it is not sorted either.
    counts = others.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    counts = materialize(counts.withColumn("rarity", F.col("held")), "dedup-rarity")
    shared = counted_join(others, counts, "token", "held", F.col("class"))
    ranked = shared.groupBy("class").agg(
        F.array_sort(F.collect_list(F.struct("rarity", "token"))).alias("rare")
    )
    frequent = held.select("class", F.filter("tokens", lambda t: t.isin(*places)).alias("frequent"))
    ranked = frequent.join(ranked, "class", "left").where("rare is not null or size(frequent) > 0")
    prefixes = map_rows(
        ranked.join(members, "class").select("class", "n", "root", "rare.token", "frequent"),
        _prefixes,
        "class bigint, n bigint, root bigint, smaller array<bigint>, larger array<bigint>",
        setup=lambda: places,
    )
    prefixes = prefixes.join(sets.select("class", _folded(F.col("bits")).alias("bits")), "class")
    prefixes = materialize(prefixes, "dedup-prefixes")
    # Keys become rows once; sizes and bitmaps are joined to those that may be of a pair.
    low = materialize(prefixes.select("class", "root", F.explode("smaller").alias("k")), "dedup-low")
    high = prefixes.select(
        F.col("class").alias("other"), F.col("root").alias("other_root"), F.explode("larger").alias("k")
    )
    high = materialize(high, "dedup-high")
    one = prefixes.select("class", "n", "bits")
    another = prefixes.select(
        F.col("class").alias("other"), F.col("n").alias("m"), F.col("bits").alias("other_bits")
    )
    each = low.select("k", "root", F.lit(1).alias("l"), F.lit(0).alias("h")).union(
        high.select("k", "other_root", F.lit(0), F.lit(1))
    )
    each = each.groupBy("k", "root").agg(F.sum("l").alias("l"), F.sum("h").alias("h"))
    each = materialize(each, "dedup-roots")
    keys = each.groupBy("k").agg(
        (F.sum("l") * F.sum("h")).alias("pairs"), F.sum(F.col("l") * F.col("h")).alias("within")
    )
    # Where enough pairs are of different roots, members meet at once. Elsewhere roots meet first, so the
    # members of a large component are not compared with each other.
    apart = F.col("pairs") - F.col("within")
    at_once = (F.col("pairs") <= AT_ONCE) & (F.col("pairs") <= AT_ONCE_SHARE * apart)
    keys = materialize(keys.where("pairs > within").select("k", at_once.alias("at_once")), "dedup-keys")
    low = materialize(low.join(keys, "k"), "dedup-low-kept")
    high = materialize(high.join(keys, "k"), "dedup-high-kept")
    some = keys.where("not at_once").select("k")
    low_roots = each.where("l > 0").select("k", "root").join(some, "k")
    high_roots = each.where("h > 0").select("k", F.col("root").alias("other_root"))
    met = low_roots.join(high_roots, "k").where("root <> other_root")
    met = materialize(met, "dedup-met")
    # Of two members of one band each is the smaller once.
    first = F.struct("n", "class") < F.struct(F.col("m").alias("n"), F.col("other").alias("class"))
    fits = first & _sizes_fit(F.col("n"), F.col("m"))
    fits = fits & _bits_fit(F.col("n"), F.col("bits"), F.col("m"), F.col("other_bits"), FOLDED)
    both = F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")
    most_low = low.where("at_once").drop("at_once").join(one, "class")
    most_high = high.where("at_once").drop("at_once").join(another, "other")
    pairs = most_low.join(most_high, "k").where(F.col("root") != F.col("other_root"))
    pairs = materialize(pairs.where(fits).select(*both).distinct(), "dedup-met-at-once")
    if not met.isEmpty():
        far_low = materialize(low.drop("at_once").join(met, ["k", "root"]), "dedup-far-low")
        far_high = high.drop("at_once").join(met, ["k", "other_root"], "left_semi")
        far_high = materialize(far_high, "dedup-far-high").join(another, "other")
        far = far_low.join(one, "class").join(far_high, ["k", "other_root"]).where(fits).select(*both)
        pairs = pairs.union(materialize(far.distinct(), "dedup-met-by-root")).distinct()
    return _allowed(pairs, sets)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(membership, links).

    Membership: per row doc_id, th (hash of the text), n_shingles, class, group (NULL if no other
    row belongs to it) and component_id.
    Links: pairs (u, v) of classes at or above the threshold that join the components.
    """
    signed = materialize(sign(docs, id_column, text_column), "dedup-signed")
    classes, links, roots = find_links(signed, docs, id_column, text_column)
    joined = classes.select("class", "least_id", "copies").join(
        roots.withColumnRenamed("node", "class"), "class", "left"
    )
    joined = joined.withColumn("root", F.coalesce("root", "class"))
    groups = joined.groupBy("root").agg(
        F.min("least_id").alias("component_id"),
        F.sum("copies").alias("copies"),
    )
    # Only groups of several rows need a look-up; the others are named by their own id.
    groups = materialize(groups.where("copies > 1").drop("copies"), "dedup-groups")
    named = joined.select("class", "root").join(groups, "root").withColumnRenamed("root", "group")
    named = materialize(named.select("class", "group", "component_id"), "dedup-names")
    rows = signed.select("doc_id", "th", F.col("n").alias("n_shingles"), "class")
    grouped = rows.where("class is not null").join(named, "class", "left")
    alone = rows.where("class is null").withColumns(
        {"group": F.lit(None).cast("long"), "component_id": F.col("doc_id")}
    )
    members = grouped.unionByName(alone).withColumn(
        "component_id", F.coalesce("component_id", "doc_id")
    )
    return members, links


def survivors(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs``, all columns, with one document of each group: the one with the smallest id.

    Of several rows with that id the one with the least text hash stays, of equal rows one.
    Documents without words stay.
    """
    members, _ = near_duplicates(docs, id_column, text_column)
    members = members.where("group is not null").select("doc_id", "th", "group", "component_id")
    members = materialize(members, "dedup-members")
    me = F.struct("doc_id", "th")
    first = members.where("doc_id <=> component_id").groupBy("group").agg(F.min(me).alias("first"))
    first = materialize(first, "dedup-first")
    id_, th = free_names(docs, "_id", "_th")
    names = [F.col("doc_id").alias(id_), F.col("th").alias(th)]
    goes = members.join(first, "group").where(~me.eqNullSafe(F.col("first"))).select(*names).distinct()
    text, name = F.col(f"`{text_column}`"), F.col(f"`{id_column}`")
    same = name.eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(th))
    kept = docs.join(goes.hint("shuffle_hash"), same, "left_anti")
    repeated = members.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = materialize(repeated.select(*names), "dedup-repeated")
    if repeated.isEmpty():
        return kept
    one = kept.join(repeated, same).drop(id_).dropDuplicates([id_column, th]).drop(th)
    return kept.join(repeated, same, "left_anti").unionByName(one)


@query("op10_minhash_dedup")
def op10_minhash_dedup(load) -> DataFrame:
    """Every document; shingles of five words, similarity of 0.75 or more."""
    members, _ = near_duplicates(load("documents"))
    return members.select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
