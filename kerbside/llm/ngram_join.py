"""N-gram Jaccard join: documents whose sets of word shingles overlap by a threshold, as connected components.

Grouped prefix join. Shingles are ordered from rare to frequent, the same for all documents. Two documents can only reach the
threshold if the first few shingles of their sets in this order, their prefixes, have one in common. Documents of identical
prefix and size form one group; groups that share a prefix shingle and suit in size are pairs; members of paired groups are
compared on their whole sets. Only which documents hang together is asked for, so pairs already connected are not compared:
every group first meets a leader of each shingle, first the one whose own shingles are shared most, as an original's are, and only
what is then still apart is compared in full. Where the first common shingle of two sets stands in both bounds their overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .durable import durable
from .shingling import U, mix, shingles, word_hashes

SIZE = 5
#: Bytes of text hashed at a time.
SLICE = 1 << 20


@dataclass(frozen=True)
class Parts:
    """How the work is cut: documents into batches, shingles into ranges of their hashes."""

    batches: int
    ranges: int


#: Bytes of a batch's text in a range, at least: some thirty shingles, so that a row of the exchange is mostly shingles.
CELL_BYTES = 200
#: Shingles of a range that are counted at a time.
COUNTED = 8 << 20


def parts_for(text_bytes: int) -> Parts:
    """Batches of up to 32 MB of text; ranges of up to 64 MB, and of more only where so many batches meet that their shares of a
    range would be smaller than CELL_BYTES. So the rows of the exchange, one a batch and range, never pass a thirtieth of the shingles."""
    batch = min(max(text_bytes // 512, 1 << 20), 32 << 20)
    batches = int(text_bytes // batch + 1)
    span = max(min(max(text_bytes // 128, 4 << 20), 64 << 20), batches * CELL_BYTES)
    return Parts(batches, int(text_bytes // span + 1))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size < SLICE):
            size += len(texts[stop] or "")
            stop += 1
        value, doc, _ = shingles(*word_hashes(texts[start:stop], lower=True), SIZE)
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        value, doc = value[new], doc[new]
        out += np.split(value, np.searchsorted(doc, np.arange(1, stop - start)))
        start = stop
    return out


def _fingerprint(values: np.ndarray) -> tuple[int, int]:
    """Two sums over a set that tell it from others, as signed longs."""
    sums = np.array([mix(values ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mix(values + U(0x14057B7EF767814F)).sum(dtype=np.uint64)], np.uint64)
    return tuple(int(x) for x in sums.view(np.int64))


def _sketch(values: np.ndarray) -> tuple[int, np.ndarray]:
    """(scale, four longs): a bit for each shingle whose hash ends in ``scale`` zeros, about a hundred of them.

    Each bit that only one of two sets has stands for a shingle that only this set has, so bits bound the overlap of sets of one scale.
    """
    scale = max(0, int(np.log2(max(1, len(values)) / 96)))
    bits = np.zeros(256, bool)
    bits[(values[values & U((1 << scale) - 1) == 0] >> U(32)) & U(255)] = True
    return scale, np.packbits(bits, bitorder="little").view(np.int64)


#: Bits of a shingle's hash that travel within a range of hashes: two shingles of a range are taken for equally rare, never
#: for equal, if they agree in these.
_LOW = U((1 << 40) - 1)


def _packed(low: np.ndarray) -> bytes:
    """Five bytes a value."""
    return low.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(data: np.ndarray) -> np.ndarray:
    """The values of rows of five bytes."""
    out = np.zeros((len(data), 8), np.uint8)
    out[:, :5] = data
    return out.reshape(-1).view(np.uint64)


def _rarity(packed: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each of a range's packed shingles, eight times the binary logarithm of how many documents hold it, 255 at most.

    Shingles are taken in slices by their leading byte, so that memory beside the range itself stays bounded.
    """
    out = np.zeros(len(packed), np.uint8)
    slices = max(1, min(256, -(-len(packed) // COUNTED)))
    for k in range(slices):
        own = np.flatnonzero((packed[:, 4] >= k * 256 // slices) & (packed[:, 4] < (k + 1) * 256 // slices)) if slices > 1 else np.arange(len(packed))
        _, at = np.unique(_unpacked(packed[own]), return_inverse=True)
        held = np.bincount(at, weights=counts[own])
        out[own] = np.minimum(8 * np.log2(held), 255).astype(np.uint8)[at]
    return out


def _by_range(tokens: np.ndarray, ranges: int) -> list[np.ndarray]:
    """Ascending hashes cut at equal steps of their values."""
    width = (1 << 64) // ranges + 1
    return np.split(tokens, np.searchsorted(tokens, np.array([k * width for k in range(1, ranges)], dtype=np.uint64)))


def _shared(keyed: DataFrame, parts: Parts) -> DataFrame:
    """(batch, range, places, rarity): which of a batch's shingles in a range other documents hold as well, and how many.

    Both sides of the exchange derive the same ascending list of a batch's shingles in a range, so places in it suffice.
    """

    def scatter(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, counts = np.unique(np.concatenate(shingle_sets(list(pdf["text"]))), return_counts=True)
        rows, start = [], 0
        for k, own in enumerate(_by_range(tokens, parts.ranges)):
            if len(own):
                low, at = np.unique(own & _LOW, return_inverse=True)
                held = np.minimum(np.bincount(at, weights=counts[start : start + len(own)]), 255).astype(np.uint8)
                rows.append((k, int(pdf["batch"].iloc[0]), _packed(low), held.tobytes()))
                start += len(own)
        return pd.DataFrame(rows, columns=["range", "batch", "tokens", "counts"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        packed = np.frombuffer(b"".join(pdf["tokens"]), np.uint8).reshape(-1, 5)
        rarity = _rarity(packed, np.frombuffer(b"".join(pdf["counts"]), np.uint8))
        rows, start = [], 0
        for batch, part, size in zip(pdf["batch"], pdf["range"], pdf["counts"].map(len), strict=True):
            mine = rarity[start : start + size]
            start += size
            if mine.any():
                rows.append((batch, part, np.flatnonzero(mine).astype(np.uint32).tobytes(), mine[mine > 0].tobytes()))
        return pd.DataFrame(rows, columns=["batch", "range", "places", "rarity"])

    ranges = keyed.groupBy("batch").applyInPandas(scatter, "range int, batch int, tokens binary, counts binary")
    return ranges.groupBy("range").applyInPandas(count, "batch int, range int, places binary, rarity binary")


def _rarities(tokens: np.ndarray, reply: pd.DataFrame, ranges: int) -> np.ndarray:
    """How frequent each of a batch's shingles is, on the scale of ``_shared``; 0 where only one document holds it."""
    answers = {k: (np.frombuffer(p, np.uint32), np.frombuffer(r, np.uint8)) for k, p, r in zip(reply["range"], reply["places"], reply["rarity"], strict=True)}
    out = []
    for k, own in enumerate(_by_range(tokens, ranges)):
        if k in answers and len(own):
            low, at = np.unique(own & _LOW, return_inverse=True)
            known = np.zeros(len(low), np.uint8)
            known[answers[k][0]] = answers[k][1]
            out.append(known[at])
        else:
            out.append(np.zeros(len(own), np.uint8))
    return np.concatenate(out)


def prefixed(docs: DataFrame, parts: Parts, percent: int) -> DataFrame:
    """(doc_id, n_shingles, key1, key2, group_key, prefix, tokens, scale, bits) of each (doc_id, text) row.

    ``prefix`` has the prefix's shingles that other documents hold too; it is null, as are ``tokens``, where there are none,
    as such a document has no partner. key1 and key2 name the whole set, ``group_key`` the whole prefix; ``bits`` is ``_sketch``'s.
    """
    keyed = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(parts.batches)).cast("int"))

    def order(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(list(left["text"]))
        known = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        rarity = _rarities(known, right, parts.ranges)
        rows = []
        for doc_id, values in zip(left["doc_id"], sets, strict=True):
            n = len(values)
            row = (doc_id, n, *_fingerprint(values), None, None, None, None, None)
            common = rarity[np.searchsorted(known, values)]
            lead = n + (-percent * n) // 100 + 1
            if n and n - np.count_nonzero(common) < lead:
                first = np.lexsort((values, common))[:lead]
                shared = values[first[common[first] > 0]]
                row = (*row[:4], _fingerprint(values[first])[0], shared.view(np.int64), values.view(np.int64), *_sketch(values))
            rows.append(row)
        return pd.DataFrame(rows, columns=["doc_id", "n_shingles", "key1", "key2", "group_key", "prefix", "tokens", "scale", "bits"])

    schema = "doc_id long, n_shingles long, key1 long, key2 long, group_key long, prefix array<long>, tokens array<long>, scale int, bits array<long>"
    return keyed.groupBy("batch").cogroup(_shared(keyed, parts).groupBy("batch")).applyInPandas(order, schema)


def _suits(size_a: Column, size_b: Column, place_a: Column, place_b: Column, percent: int) -> Column:
    """Whether two sets can reach the threshold if their first common shingle stands at these places.

    Their sizes must not differ too much, and what follows from there on must be enough for the overlap needed.
    """
    rest = F.least(size_a - place_a, size_b - place_b)
    return (F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent) & (rest * (100 + percent) >= (size_a + size_b) * percent)


def _verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of members whose whole sets reach the threshold."""
    left = members.select(F.col("member").alias("a"), F.col("tokens").alias("tokens_a"))
    right = members.select(F.col("member").alias("b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= (F.size("tokens_a") + F.size("tokens_b") - both) * percent).select("a", "b")


def _star_pairs(entries: DataFrame, members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each group's members with the first member of a leading group of a shared prefix shingle.

    Groups of a shingle are banded by size, so that a leader suits many; each meets those of its own and the next lower band. In
    the first turn the group with the fewest shingles of its own leads, later one drawn by a hash.
    """
    banded = entries.withColumn("band", F.floor(F.log("n_shingles") / F.log(F.lit(100 / percent))).cast("int"))
    draw = F.col("own_shingles") if turn == 0 else F.xxhash64("group", F.lit(turn))
    pick = F.min(F.struct(draw.alias("draw"), "group", "n_shingles", "place")).alias("lead")
    leaders = banded.groupBy("token", "band").agg(pick)
    met = banded.withColumn("band", F.explode(F.array("band", F.col("band") - 1))).join(leaders, ["token", "band"])
    fits = _suits(F.col("n_shingles"), F.col("lead.n_shingles"), F.col("place"), F.col("lead.place"), percent)
    pairs = met.where(fits).select("group", F.col("lead.group").alias("a")).distinct()
    return pairs.join(members.select("group", F.col("member").alias("b")), "group").where("a <> b").select("a", "b")


#: Members that meet the same number of others in one key of the join below.
BLOCK = 1000


def _rest_pairs(entries: DataFrame, members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one group, or of groups with a common prefix shingle, that are not connected yet, once each.

    Only pairs that sizes, places and sketches allow come out. Members of a shingle meet by bands of size, the smaller with
    those of its own and the next band; a band of more than BLOCK members is cut into blocks, and each two blocks meet under a
    key of their own, so that a shingle of very many documents is spread over tasks.
    """
    named = members.select("group", "member", "component")
    rows = entries.select("token", "group", "n_shingles", "place").join(named, "group").select("token", F.lit(False).alias("inside"), "n_shingles", "place", "member", "component")
    inside = members.join(sketches.select("member", "n_shingles"), "member")
    inside = inside.select(F.col("group").alias("token"), F.lit(True).alias("inside"), "n_shingles", F.lit(0).cast("long").alias("place"), "member", "component")
    rows = rows.unionByName(inside)
    apart = rows.groupBy("token", "inside").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token", "inside")
    banded = rows.join(apart, ["token", "inside"]).join(sketches.select("member", "scale", "bits"), "member")
    kept = durable(banded.withColumn("band", F.floor(F.log("n_shingles") / F.log(F.lit(100 / percent))).cast("int")))
    larger = kept.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    key = ["token", "inside", "band"]
    blocks = larger.groupBy(key).agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
        cut = df.join(blocks, key).withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return cut.select(*key, "i", "j", *(F.col(c).alias(c + own) for c in ("member", "component", "n_shingles", "place", "scale", "bits")))

    left, right = dealt(kept, "i", "j"), dealt(larger, "j", "i")
    a, b = ({c: F.col(c + side) for c in ("member", "component", "n_shingles", "place", "scale", "bits")} for side in "ij")
    once = (a["n_shingles"] < b["n_shingles"]) | ((a["n_shingles"] == b["n_shingles"]) & (a["member"] < b["member"]))
    fits = _suits(a["n_shingles"], b["n_shingles"], a["place"], b["place"], percent)
    lost = [sum((F.bit_count(x["bits"][k].bitwiseAND(F.bitwise_not(y["bits"][k]))) for k in range(4)), F.lit(0)) for x, y in ((a, b), (b, a))]
    overlap = F.least(a["n_shingles"] - lost[0], b["n_shingles"] - lost[1])
    alike = (a["scale"] != b["scale"]) | (overlap * (100 + percent) >= (a["n_shingles"] + b["n_shingles"]) * percent)
    pairs = left.join(right, [*key, "i", "j"]).where((a["component"] != b["component"]) & once & fits & alike)
    return pairs.select(a["member"].alias("a"), b["member"].alias("b")).distinct()


def _renamed(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the components that ``links`` make of them."""
    names = connected_components(links)
    return members.drop("component").join(names, members["member"] == names["node"], "left").select(
        "group", "member", F.coalesce("component", "member").alias("component")
    )


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 80, stars: int = 2) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Words are split at ASCII white space, A-Z lower-cased; a set holds the distinct five-word shingles, or the whole sequence of
    fewer words. Null texts and those without words have empty sets and link with nothing, themselves excepted: they are their
    own component. Documents link at ``percent`` % Jaccard similarity or more; a component is named by its smallest doc_id. Rows
    of the same id and text give equal rows; different texts of one id, and of no id, stand for themselves, told apart by a 64-bit
    hash of id and text. Very long texts are one row of one batch. No bucket, group or candidate list is capped. Other columns are not
    read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is null or n > 1").limit(1).count()
    if not odd:
        return _components(rows, percent, stars)
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.concat(F.lit("t"), "text"), F.lit("null")))
    keyed = rows.select(key.alias("key"), "doc_id", "text")
    named = keyed.select("key", "doc_id").join(_components(keyed.select(F.col("key").alias("doc_id"), "text").dropDuplicates(["doc_id"]), percent, stars).toDF("key", "n_shingles", "component"), "key")
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(names, "component").select("doc_id", "n_shingles", "component_id")


def _components(rows: DataFrame, percent: int, stars: int) -> DataFrame:
    """The result for (doc_id, text) rows whose ids are neither null nor repeated."""
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    found = durable(prefixed(rows, parts_for(size), percent))
    held = found.where("prefix is not null")
    same_set = ["key1", "key2", "n_shingles"]
    # One member stands for all copies of a set; groups of identical prefix and size take the name of their first member.
    firsts = held.groupBy(same_set).agg(F.min("doc_id").alias("member"), F.min("group_key").alias("group_key"))
    groups = firsts.groupBy("group_key", "n_shingles").agg(F.min("member").alias("group"))
    classes = durable(firsts.join(groups, ["group_key", "n_shingles"]).select(*same_set, "member", "group"))
    sets = held.select(F.col("doc_id").alias("member"), *same_set, "prefix", "tokens", "scale", "bits").join(classes, ["member", *same_set])
    sets = durable(sets.select("member", "group", "n_shingles", "prefix", "tokens", "scale", "bits"))
    grouped = sets.where(F.col("member") == F.col("group"))
    # The shingles that a document shares with none come first in its order, so the place of the others follows from their number.
    lead = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    entries = grouped.select("group", "n_shingles", (lead - F.size("prefix")).alias("own_shingles"), F.posexplode("prefix").alias("at", "token"))
    entries = entries.withColumn("place", F.col("own_shingles") + F.col("at")).drop("at")
    busy = entries.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    entries = durable(entries.join(busy, "token"))
    members = sets.select("group", "member", F.col("member").alias("component"))
    inside = members.where("group <> member").select(F.col("group").alias("a"), F.col("member").alias("b"))
    links: DataFrame | None = None
    for turn in range(stars + 1):
        if turn < stars:
            pairs = _star_pairs(entries, members, turn, percent)
            pairs = (pairs.union(inside) if turn == 0 else pairs).distinct()
            if turn:
                name = members.select("member", "component")
                pairs = pairs.join(name.toDF("a", "ca"), "a").join(name.toDF("b", "cb"), "b").where("ca <> cb").select("a", "b")
        else:
            pairs = _rest_pairs(entries, members, sets, percent)
        new = durable(_verified(pairs, sets, percent))
        if new.limit(1).count():
            links = new if links is None else links.union(new)
            members = durable(_renamed(members, links))
    named = classes.join(members.select("member", "component"), "member").select(*same_set, "component")
    # Sets without a partner, the most of them, need no join.
    alone = found.where("prefix is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    joined = held.select("doc_id", *same_set).join(named, same_set)
    return alone.unionByName(joined.select("doc_id", "n_shingles", F.col("component").alias("component_id")))
