"""Near-duplicate documents by DartMinHash.

A document is the multiset of its five-word shingles. Each shingle, its count as weight, is a region
of a plane of weight and rank on which darts fall at random, the same darts for all documents, as
hashes of the shingle decide them. Every dart belongs to one of 160 coordinates; of those that hit the
regions of a document, the dart of lowest rank is its value at that coordinate. Ranks are gone
through in growing levels until all coordinates have a value, so a long document throws about one
dart for each shingle and a short one some darts for each coordinate. Two documents agree at a
coordinate with the probability of their weighted Jaccard similarity.

Five coordinates make a band. A pair at similarity 0.8 shares none of the 32 bands three times in a
million; all pairs that share one are settled exactly, without listing the pairs of a large bucket:

1. Equal texts are one class and enter once.
2. In each bucket one member, drawn by hash, is compared with every other.
3. Where that leaves a bucket in several components, the members outside its largest component are
   compared with those of other components in it. Members of one component need no comparison.
   Before, members of a large bucket are compared with the one that has most in shingles of many
   texts, and with those they share shingles of few texts with; of other pairs in it, those are
   compared that have enough in shingles of many texts to be as similar.

Comparisons are left out where 160 bits of the signatures differ so much that a similarity of 0.8 is
more than five standard deviations away; all others are by exact weighted Jaccard similarity.

Cases: documents whose text is null or has no words, and rows without doc_id, are alone; texts of one
to four words have one shingle; equal rows are one document listed twice and get equal results; a
doc_id with several texts gets a row for each; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.batches import mix, shingles, slices, unit, weighted, word_hashes
from tillflow.llm.graph import components
from tillflow.llm.storage import every_column, scratch, text_key, written

WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 32, 5
COORDINATES = BANDS * BAND_ROWS
_LONGS = -(-COORDINATES // 64)
# Members of a bucket, or texts that have a shingle, that are paired as they are.
FEW = 128
_ROUNDING = 1e-6
_U64 = np.uint64


# Signatures ------------------------------------------------------------------------


def most_different_bits(similarity: float) -> int:
    """Of the bits of two signatures, how many may differ at this similarity, with ample room."""
    share = (1 - similarity) / 2
    return int(COORDINATES * share + 5.5 * np.sqrt(COORDINATES * share * (1 - share)))


@lru_cache(maxsize=64)
def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2 and so on darts in an area."""
    counts = np.arange(1, int(mean + 12 * np.sqrt(mean) + 20))
    logs = np.concatenate([[0.0], np.cumsum(np.log(mean) - np.log(counts))]) - mean
    return np.cumsum(np.exp(logs))


def _level(number: int) -> tuple[float, float]:
    """Start and width of levels 0 to 1, 1 to 2, 2 to 4, 4 to 8 and so on."""
    return (0.0, 1.0) if number == 0 else (float(1 << (number - 1)), float(1 << (number - 1)))


def dart_minhash(codes: np.ndarray, of: np.ndarray, weights: np.ndarray, rows: int) -> np.ndarray:
    """Per row and coordinate, the rank of the dart that wins it; infinite for rows without elements.

    codes, of, weights: distinct elements of each row, in order of the rows.
    """
    best = np.full((rows, COORDINATES), np.inf)
    flat = best.ravel()
    level = 0
    while len(codes):
        rank_start, rank_width = _level(level)
        band = 0
        while True:
            weight_start, weight_width = _level(band)
            reached = np.flatnonzero(weights > weight_start)
            if not len(reached):
                break
            salt = mix(np.array([(level << 8) | band], dtype=np.uint64) + _U64(0xD1B54A32D192ED03))[0]
            base = mix(codes[reached] ^ salt)
            darts = np.searchsorted(_poisson(rank_width * weight_width), unit(base), side="right")
            element = np.repeat(np.arange(len(reached)), darts)
            if len(element):
                serial = np.arange(len(element)) - np.repeat(np.cumsum(darts) - darts, darts)
                dart = mix(base[element] + (serial.astype(np.uint64) + _U64(1)) * _U64(0x9E3779B97F4A7C15))
                height = weight_start + unit(mix(dart ^ _U64(0xA0761D6478BD642F))) * weight_width
                at = reached[element]
                hit = height < weights[at]
                dart, at = dart[hit], at[hit]
                rank = rank_start + unit(dart) * rank_width
                coordinate = mix(dart ^ _U64(0xE7037ED1A0B428DB)) % _U64(COORDINATES)
                np.minimum.at(flat, of[at] * COORDINATES + coordinate.astype(np.int64), rank)
            band += 1
        # Later levels hold higher ranks only: rows with all coordinates won are done.
        open_rows = np.isinf(best).any(axis=1)
        still = open_rows[of]
        codes, of, weights = codes[still], of[still], weights[still]
        level += 1
    return best


def signature_bits(ranks: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, packed into longs."""
    bits = (mix(ranks.view(np.uint64).copy()) >> _U64(63)).astype(np.uint8)
    padded = np.zeros((len(bits), _LONGS * 64), dtype=np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1).view("<i8")


def band_keys(ranks: np.ndarray) -> np.ndarray:
    """Per row and band, a hash of its coordinates."""
    values = mix(ranks.view(np.uint64).copy()).reshape(len(ranks), BANDS, BAND_ROWS)
    keys = np.zeros((len(ranks), BANDS), dtype=np.uint64)
    for k in range(BAND_ROWS):
        keys = mix(keys + values[:, :, k])
    return mix(keys ^ mix(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


def _elements(text: pa.Array):
    words, counts = word_hashes(text)
    return weighted(*shingles(words, counts, WORDS)), counts


def _signed(batches):
    for batch in batches:
        text = batch.column("text")
        for a, b in slices(text):
            (codes, of, weights), counts = _elements(text.slice(a, b - a))
            ranks = dart_minhash(codes, of, weights.astype(np.float64), b - a)
            bits = signature_bits(ranks)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (b - a) * BANDS + 1, BANDS, dtype=np.int32)),
                pa.array(band_keys(ranks).ravel()),
            )
            packed = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (b - a) * _LONGS + 1, _LONGS, dtype=np.int32)),
                pa.array(bits.ravel()),
            )
            own = [batch.column(c).slice(a, b - a) for c in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(counts > 0), bands, packed],
                ["doc_id", "text_key", "filled", "bands", "bits"],
            )


def different_bits(a: Column, b: Column) -> Column:
    total = F.lit(0)
    for k in range(_LONGS):
        total = total + F.bit_count(a[k].bitwiseXOR(b[k]))
    return total


# Verification ------------------------------------------------------------------------


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of the texts in each row; 0 where one has no words."""
    sides = [_elements(left)[0], _elements(right)[0]]
    rows = len(left)
    totals = [np.bincount(of, weights, minlength=rows) for _, of, weights in sides]
    codes = np.concatenate([s[0] for s in sides])
    of = np.concatenate([s[1] for s in sides])
    weights = np.concatenate([s[2] for s in sides])
    order = np.lexsort((codes, of))
    codes, of, weights = codes[order], of[order], weights[order]
    both = np.flatnonzero((codes[1:] == codes[:-1]) & (of[1:] == of[:-1]))
    shared = np.bincount(of[both], np.minimum(weights[both], weights[both + 1]), minlength=rows)
    union = totals[0] + totals[1] - shared
    return np.divide(shared, union, out=np.zeros(rows), where=union > 0)


def _compared(batches):
    for batch in batches:
        for a, b in slices(batch.column("u"), 1 << 20):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("a"),
                    part.column("b"),
                    pa.array(similarities(part.column("u"), part.column("v"))),
                ],
                ["a", "b", "similarity"],
            )


def _listed(batches):
    """The shingles of each text and how often it has them."""
    for batch in batches:
        text = batch.column("text")
        for a, b in slices(text, 1 << 20):
            (codes, of, weights), _ = _elements(text.slice(a, b - a))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(a, b - a).take(pa.array(of)),
                    pa.array(codes.view(np.int64)),
                    pa.array(weights),
                ],
                ["id", "code", "weight"],
            )


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    of_a = texts.select(F.col("id").alias("a"), F.col("text").alias("u"))
    of_b = texts.select(F.col("id").alias("b"), F.col("text").alias("v"))
    compared = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "u", "v")
    compared = compared.mapInArrow(_compared, "a long, b long, similarity double")
    return written(
        compared.where(F.col("similarity") >= similarity).select("a", "b"), "text-links"
    )


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


# The operator --------------------------------------------------------------------------


def near_documents(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: component_id, the least doc_id of its group, and whether it stays."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    results = _placed(docs, similarity).select("doc_id", "component_id")
    alone = docs.where("doc_id IS NULL OR text IS NULL").select(
        "doc_id", F.lit(None).cast(kind).alias("component_id")
    )
    return results.union(alone).select(
        "doc_id",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _placed(docs: DataFrame, similarity: float) -> DataFrame:
    """doc_id, text_key, group and component_id, the least doc_id of the group, of rows with both.

    Group and component_id are null where a text has no words. All else that is written is removed.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(written(_grouped(docs, similarity), "text-groups"))


def _grouped(docs: DataFrame, similarity: float) -> DataFrame:
    bits = most_different_bits(similarity)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    signed = written(
        keyed.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
            _signed,
            f"doc_id {kind}, text_key string, filled boolean, bands array<long>, bits array<long>",
        ),
        "text-signatures",
    )
    classes = written(
        signed.where("filled")
        .groupBy("text_key")
        .agg(
            F.min("doc_id").alias("first"),
            F.any_value("bands").alias("bands"),
            F.any_value("bits").alias("bits"),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "text-classes",
    )
    banded = classes.select("id", "bits", F.explode("bands").alias("band"))
    buckets = written(
        banded.groupBy("band")
        .agg(
            F.count("*").alias("members"),
            F.min(F.struct(F.xxhash64("band", "id").alias("draw"), "id", "bits")).alias("drawn"),
        )
        .where("members > 1")
        .select("band", F.col("drawn.id").alias("rep"), F.col("drawn.bits").alias("rep_bits")),
        "text-buckets",
    )
    members = written(banded.join(buckets, "band"), "text-members")
    # Texts that any comparison may need.
    needed = members.select("id").distinct().join(classes.select("id", "first", "text_key"), "id")
    texts = written(
        keyed.join(
            needed.select(F.col("first").alias("doc_id"), "text_key", "id"), ["doc_id", "text_key"]
        ).select("id", "text"),
        "text-compared",
    )
    drawn = (
        members.where("id <> rep")
        .where(different_bits(F.col("bits"), F.col("rep_bits")) <= bits)
        .select(*_ordered("id", "rep"))
        .distinct()
    )
    links = _verified(drawn, texts, similarity)
    mixed = _mixed(members, components(links))
    shares, by_few = _by_shingles(mixed, texts, similarity)
    near = by_few.union(_central(mixed, shares, similarity)).distinct()
    links = links.union(_verified(near, texts, similarity))
    rest = _strays(_mixed(members, components(links)), shares, similarity)
    found = components(links.union(_verified(rest, texts, similarity)))
    known = written(_named(classes, found), "text-known")
    return signed.join(known, "text_key", "left").select(
        "doc_id", "text_key", "group", "component_id"
    )


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets of several components, with the size of the bucket and its largest."""
    placed = written(
        members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")),
        "text-placed",
    )
    largest = (
        placed.groupBy("band", "component")
        .count()
        .groupBy("band")
        .agg(
            F.count("*").alias("parts"),
            F.sum("count").alias("size"),
            F.max(F.struct("count", "component"))["component"].alias("largest"),
        )
        .where("parts > 1")
        .select("band", "size", "largest")
    )
    return written(placed.join(written(largest, "text-mixed"), "band"), "text-strays")


def _central(mixed: DataFrame, shares: DataFrame, similarity: float) -> DataFrame:
    """Pairs of each member of a large bucket with the one that has most in frequent shingles."""
    shared = mixed.where(F.col("size") > FEW).join(shares, "id")
    shared = written(shared.select("band", "id", "component", "total", "common"), "text-shared")
    centre = shared.groupBy("band").agg(
        F.max(F.struct("common", "id", "component", "total")).alias("centre")
    )
    most = F.least("common", "centre.common")
    return (
        shared.join(written(centre, "text-centres"), "band")
        .where(F.col("component") != F.col("centre.component"))
        .where(most >= _shared_at(similarity, F.col("total"), F.col("centre.total")))
        .select(*_ordered("id", "centre.id"))
    )


def _strays(mixed: DataFrame, shares: DataFrame, similarity: float) -> DataFrame:
    """Pairs in buckets of several components that were not compared with one another.

    Members of a bucket of more than FEW are paired with one another only where their frequent
    shingles leave the similarity possible.
    """
    # In a large bucket all have shares; those that frequent shingles bring to no other are out.
    possible = F.col("common") >= similarity * F.col("total") - _ROUNDING
    mixed = mixed.where("id <> rep").join(shares, "id", "left")
    mixed = mixed.where((F.col("size") <= FEW) | possible)
    columns = ("band", "id", "component", "bits", "common", "total")
    stray = mixed.where("component <> largest").select(*[F.col(c).alias(f"x_{c}") for c in columns])
    other = mixed.select(*[F.col(c).alias(f"y_{c}") for c in columns])
    close = different_bits(F.col("x_bits"), F.col("y_bits")) <= most_different_bits(similarity)
    apart = F.col("x_component") != F.col("y_component")
    unknown = F.col("x_common").isNull() | F.col("y_common").isNull()
    needed = _shared_at(similarity, F.col("x_total"), F.col("y_total"))
    within = unknown | (F.least("x_common", "y_common") >= needed)
    return (
        stray.join(other, (F.col("x_band") == F.col("y_band")) & apart & close & within)
        .select(*_ordered("x_id", "y_id"))
        .distinct()
    )


def _shared_at(similarity: float, total: Column, other: Column) -> Column:
    """The weight that texts of these weights have in common at this similarity."""
    return (total + other) * (similarity / (1 + similarity)) - _ROUNDING


def _by_shingles(
    mixed: DataFrame, texts: DataFrame, similarity: float
) -> tuple[DataFrame, DataFrame]:
    """What shingles allow the texts in large buckets: two texts have no more weight in common than
    the lesser of their weights in frequent shingles, and what they share of others.

    Gives id, total and common, its weight in shingles that more than FEW of these texts have; and
    the pairs of different components that share others and can be as similar. A shingle of few
    texts makes at most FEW pairs for each of them, so both grow as the texts do.
    """
    crowded = mixed.where(F.col("size") > FEW).select("id", "component").distinct()
    crowded = written(crowded, "text-crowded")
    listed = written(
        texts.join(crowded.select("id"), "id").mapInArrow(_listed, "id long, code long, weight long"),
        "crowded-shingles",
    )
    few = listed.groupBy("code").agg(F.count("*").alias("texts")).where(F.col("texts") <= FEW)
    few = written(listed.join(few.hint("merge"), "code"), "few-shingles")
    uncommon = few.groupBy("id").agg(F.sum("weight").alias("uncommon"))
    shares = written(
        listed.groupBy("id")
        .agg(F.sum("weight").alias("total"))
        .join(uncommon, "id", "left")
        .select("id", "total", (F.col("total") - F.coalesce("uncommon", F.lit(0))).alias("common")),
        "crowded-shares",
    )
    sides = few.where("texts > 1").join(crowded, "id").join(shares, "id")
    sides = written(sides.select("code", "id", "component", "weight", "total", "common"), "few-sides")
    x, y = sides.alias("x"), sides.alias("y")
    apart = F.col("x.component") != F.col("y.component")
    shared = (
        x.join(y, (F.col("x.code") == F.col("y.code")) & (F.col("x.id") < F.col("y.id")) & apart)
        .groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .agg(
            F.sum(F.least("x.weight", "y.weight")).alias("shared"),
            F.first(F.least("x.common", "y.common")).alias("most"),
            F.first(_shared_at(similarity, F.col("x.total"), F.col("y.total"))).alias("least"),
        )
        .where(F.col("most") + F.col("shared") >= F.col("least"))
        .select("a", "b")
    )
    return shares, shared


def _named(classes: DataFrame, found: DataFrame) -> DataFrame:
    """Of each class of equal texts, its component and the least doc_id of that."""
    firsts = classes.select("id", "text_key", "first").join(found, "id", "left")
    alone = firsts.where("component IS NULL").select(
        "text_key", F.col("id").alias("group"), F.col("first").alias("component_id")
    )
    grouped = firsts.where("component IS NOT NULL")
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    return alone.union(
        grouped.join(least, "component").select("text_key", "component", "component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Documents with all their columns, one of each group; rows without doc_id all stay.

    Of a doc_id with several texts each text is a document of its own; of rows that repeat doc_id
    and text one stays. A null text is an empty one; texts without words all stay. Further columns
    may have any names.
    """
    placed = _placed(docs, SIMILARITY).where("group IS NOT NULL")
    first = placed.groupBy("group").agg(
        F.count("*").alias("members"), F.min(F.struct("doc_id", "text_key")).alias("stays")
    )
    gone = (
        placed.join(first.where("members > 1"), "group")
        .where(F.struct("doc_id", "text_key") != F.col("stays"))
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    )
    whole = F.struct(*every_column(docs)).alias("row")
    # Rows that repeat are dropped where those that go are: whole rows are shuffled once.
    listed = (
        docs.where("doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_key"), whole)
        .dropDuplicates(["_id", "_key"])
        .join(gone, ["_id", "_key"], "left_anti")
        .select("row")
    )
    return listed.union(docs.where("doc_id IS NULL").select(whole)).select("row.*")
