"""A Merkle manifest of a table of documents, kept as an append log in postorder.

Every row is a leaf. The leaves of a language, in the order of their ids, are the bottom of a binary
tree whose last node may have one child; the subroots of the languages are the bottom of another one.

Nodes are written in the order in which they are complete: a leaf, then every ancestor that it
completes. In such a log the place of a node follows from the sizes of the subtrees before it and of its
own (`position`), so a proof is read by computing places, without pointers and without a search.

Builders are aligned: each takes all nodes below one node that is `BLOCK_LEVELS` levels up, and writes
their part of the log as one row. The nodes that builders end in are what the builders of the next tier
start from, so a tree of n leaves takes log2(n) / BLOCK_LEVELS tiers, and no task holds more than a
block, however many rows one language has. Proofs come down the same way: a block reads the steps
within itself from its part of the log, and those above from the builder that it ends in.

Each text is read and hashed once, in the JVM; after that only digests are sorted and shuffled. The
driver sees a count per partition and the size of the largest tree.

Cases: a null field is written as `-`, unlike an empty one; rows without id come first, rows without
language form a tree of their own, which comes first; rows that repeat an id go by their digest, equal
rows are leaves of their own with equal digests but proofs of their own; an empty table gives no rows;
further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.sharding import numbered
from tillflow.llm.storage import written

BLOCK_LEVELS = 11
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
_STEPS = "steps array<struct<left: string, right: string>>"
_UPPER = f"tree long, index long, subroot string, root string, {_STEPS}"


# The log ---------------------------------------------------------------------


def combine(*children: str) -> str:
    """Digest of a node from those of its children."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves."""
    return max(0, leaves - 1).bit_length()


def _subtree(leaves: int, level: int) -> int:
    """Nodes of a subtree of so many leaves whose top is at `level`."""
    return sum(-(-leaves >> k) for k in range(level + 1))


def position(level: int, index: int, leaves: int) -> int:
    """Place in the log of the node number `index` of a level, in a tree of so many leaves.

    The m leaves to its left form complete subtrees, one for each bit of m, of two nodes a leaf but
    one. They come before its own subtree, of which it is the last.
    """
    before = index << level
    own = min(1 << level, leaves - before)
    return 2 * before - before.bit_count() + _subtree(own, level) - 1


def append_all(leaves: list[str], levels: int) -> list[str]:
    """The log of the tree above these leaves, as far up as `levels`; its last entry is the top."""
    log, waiting = [], []

    def climb(level: int, node: str, to: int, last: bool) -> None:
        log.append(node)
        while level < to:
            if waiting and waiting[-1][0] == level:
                node = combine(waiting.pop()[1], node)
            elif last:
                node = combine(node)
            else:
                break
            level += 1
            log.append(node)
        waiting.append((level, node))

    for number, leaf in enumerate(leaves):
        climb(0, leaf, levels, number == len(leaves) - 1)
    return log


def sibling_steps(log: list[str], leaves: int, levels: int, above: list) -> list[list]:
    """Per leaf of a log, what stands left and right of its ancestors, from the leaf upwards.

    above: the steps from the top of this log on.
    """
    steps = [above]
    for level in range(levels - 1, -1, -1):
        count, below = -(-leaves >> level), []
        for index in range(count):
            other, left, right = index ^ 1, "", ""
            if other < count:
                digest = log[position(level, other, leaves)]
                left, right = (digest, "") if other < index else ("", digest)
            below.append([(left, right), *steps[index >> 1]])
        steps = below
    return steps


def fold(leaf: str, steps: list) -> str:
    """The root that a leaf and its proof lead to."""
    for left, right in steps:
        leaf = combine(left, leaf, right)
    return leaf


# Tiers of builders -----------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """tiers: per tier, a row (tree, block, size, log) of each builder; roots: tree and its root."""

    tiers: list[DataFrame]
    roots: DataFrame
    step: int


@dataclass(frozen=True)
class Tier:
    """Builders that go up `step` levels from the level number * step."""

    number: int
    step: int

    def nodes(self, size: int) -> int:
        """How many nodes a tree of `size` leaves has where these builders start."""
        return -(-size >> (self.number * self.step))

    def levels(self, size: int) -> int:
        return min(height(self.nodes(size)), self.step)

    def below(self, size: int, block: int) -> int:
        """How many nodes one builder starts from."""
        return min(1 << self.step, self.nodes(size) - (block << self.step))

    def ends(self) -> Column:
        """Whether the tree ends in a builder of this tier."""
        return F.col("size") <= F.lit(1 << ((self.number + 1) * self.step))

    def steps(self, row: dict) -> list[list]:
        """Per node that a builder starts from, the steps up to the root of all."""
        above = [(s["left"], s["right"]) for s in row["steps"]]
        below = self.below(row["size"], row["block"])
        return sibling_steps(row["log"], below, self.levels(row["size"]), above)


def _appended(tier: Tier):
    """The nodes that one builder starts from, as its part of the log."""

    def append(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        first = table.slice(0, 1)
        log = append_all(table["digest"].to_pylist(), tier.levels(first["size"][0].as_py()))
        columns = {name: first[name] for name in ("tree", "block", "size")}
        return pa.table({**columns, "log": pa.array([log], pa.list_(pa.string()))})

    return append


def build(leaves: DataFrame, most: int, step: int = BLOCK_LEVELS) -> Tree:
    """leaves: tree, index from 0, size (leaves of its tree) and digest; most: the largest size."""
    tiers, roots, nodes = [], None, leaves
    while True:
        tier = Tier(len(tiers), step)
        built = (
            nodes.withColumn("block", F.shiftright("index", step))
            .select("tree", "block", "index", "size", "digest")
            .groupBy("tree", "block")
            .applyInArrow(_appended(tier), "tree long, block long, size long, log array<string>")
        )
        built = written(built, f"merkle-log-{tier.number}")
        tiers.append(built)
        top = F.element_at("log", -1)
        done = built.where(tier.ends()).select("tree", top.alias("root"))
        roots = done if roots is None else roots.union(done)
        if tier.nodes(most) <= 1 << step:
            return Tree(tiers, written(roots, "merkle-roots"), step)
        nodes = built.where(~tier.ends()).select(
            "tree", F.col("block").alias("index"), "size", top.alias("digest")
        )


def _with_steps(tree: Tree, tier: Tier, above: DataFrame | None, tops: DataFrame) -> DataFrame:
    """Builders of a tier with the steps above them: from the tier above, or of trees that end here."""
    builders = tree.tiers[tier.number]
    ending = tops.join(builders.where(tier.ends()).select("tree"), "tree", "left_semi")
    upper = ending if above is None else above.union(ending)
    return builders.join(upper.withColumnRenamed("index", "block"), ["tree", "block"])


def block_steps(tree: Tree, tops: DataFrame) -> DataFrame:
    """For every builder of the lowest tier its part of the log and the steps above it.

    tops: tree, subroot, root and the steps from the root of each tree on.
    """
    zero = F.lit(0).cast("long").alias("index")
    tops = tops.select("tree", zero, "subroot", "root", "steps")
    above = None
    for number in range(len(tree.tiers) - 1, 0, -1):
        tier = Tier(number, tree.step)
        joined = _with_steps(tree, tier, above, tops)
        above = written(joined.mapInArrow(_unfolded(tier), _UPPER), "merkle-steps")
    return _with_steps(tree, Tier(0, tree.step), above, tops)


def _unfolded(tier: Tier):
    """Builders with the steps above them, as a row for every node that they start from."""

    def down(batches):
        for batch in batches:
            out = {name: [] for name in schema.names}
            for row in batch.to_pylist():
                for k, steps in enumerate(tier.steps(row)):
                    out["tree"].append(row["tree"])
                    out["index"].append((row["block"] << tier.step) + k)
                    out["subroot"].append(row["subroot"])
                    out["root"].append(row["root"])
                    out["steps"].append([{"left": a, "right": b} for a, b in steps])
            yield pa.RecordBatch.from_pydict(out, schema)

    schema = _arrow_upper()
    return down


def _arrow_upper() -> pa.Schema:
    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    return pa.schema(
        [
            ("tree", pa.int64()),
            ("index", pa.int64()),
            ("subroot", pa.string()),
            ("root", pa.string()),
            ("steps", pa.list_(step)),
        ]
    )


# Documents -------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row, with some fields changed."""
    parts = [_field(changed.get(name, F.col(name))) for name in FIELDS]
    return F.sha2(F.concat(*parts), 256)


def tampered_digest() -> Column:
    """Digest of the row after tampering, null for rows that are left alone."""
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % TAMPER_EVERY == 0
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    return F.when(chosen, leaf_digest(n_chars=more))


@dataclass(frozen=True)
class Manifest:
    """leaves: doc_id, changed, tree, index, size, digest; trees: tree, lang, size, and the logs."""

    leaves: DataFrame
    trees: DataFrame
    by_lang: Tree
    over_langs: Tree


def manifest(
    docs: DataFrame, changed: Column | None = None, step: int = BLOCK_LEVELS
) -> Manifest | None:
    """Logs of all trees over the documents; None for an empty table.

    changed: a digest to fold in place of a row's own, for tests of tampering; step: how many levels a
    builder goes up.
    """
    other = F.lit(None).cast("string") if changed is None else changed
    digests = docs.select("doc_id", "lang", leaf_digest().alias("digest"), other.alias("changed"))
    rows, total = numbered(written(digests, "merkle-leaves"), "lang", "doc_id", "digest")
    if not total:
        return None
    langs = rows.groupBy("lang").agg(F.min("row_number").alias("start"), F.count("*").alias("size"))
    ordered, count = numbered(written(langs, "merkle-langs"), "lang")
    trees = written(ordered.withColumnRenamed("row_number", "tree"), "merkle-trees")
    most = trees.agg(F.max("size")).first()[0]
    # Written, so its size is known: as small as languages are few, it is sent to all tasks.
    named = trees.select(F.col("lang").alias("of"), "tree", "start", "size")
    placed = rows.join(named, rows["lang"].eqNullSafe(named["of"])).withColumn(
        "index", F.col("row_number") - F.col("start")
    )
    leaves = placed.select("doc_id", "changed", "tree", "index", "size", "digest")
    by_lang = build(leaves, most, step)
    tops = by_lang.roots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("index"),
        F.lit(count).cast("long").alias("size"),
        F.col("root").alias("digest"),
    )
    return Manifest(leaves, trees, by_lang, build(tops, count, step))


def lang_steps(made: Manifest) -> DataFrame:
    """Per language its tree, subroot, the root of all and the steps between."""
    none = F.from_json(F.lit("[]"), "array<struct<left: string, right: string>>").alias("steps")
    roots = made.over_langs.roots.select("tree", F.lit("").alias("subroot"), "root", none)
    blocks = block_steps(made.over_langs, roots)
    steps = blocks.mapInArrow(_unfolded(Tier(0, made.over_langs.step)), _UPPER).select(
        F.col("index").alias("tree"), "root", "steps"
    )
    subroots = made.by_lang.roots.withColumnRenamed("root", "subroot")
    return written(steps.join(subroots, "tree"), "merkle-lang-steps")


def proofs(made: Manifest) -> DataFrame:
    """One row per leaf: its proof, and the root that folding its changed digest, or its own, gives.

    `proof` holds what stands left and right of the leaf and its ancestors; one side at most is not
    empty. `position` is the leaf's place in the log of its language.
    """
    tier = Tier(0, made.by_lang.step)
    leaves = made.leaves.withColumn("block", F.shiftright("index", tier.step))
    blocks = block_steps(made.by_lang, lang_steps(made))

    def extract(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        (block,) = blocks.to_pylist()
        rows = rows.sort_by("index")
        steps = tier.steps(block)
        digests, changed = rows["digest"].to_pylist(), rows["changed"].to_pylist()
        folded = [fold(c or d, s) for d, c, s in zip(digests, changed, steps, strict=True)]
        numbers = rows["index"].to_pylist()
        same = rows.num_rows
        return pa.table(
            {
                "doc_id": rows["doc_id"],
                "leaf": rows["digest"],
                "subroot": pa.array([block["subroot"]] * same, pa.string()),
                "root": pa.array([block["root"]] * same, pa.string()),
                "proof": pa.array(
                    [[{"left": a, "right": b} for a, b in s] for s in steps],
                    _arrow_upper().field("steps").type,
                ),
                "folded_root": pa.array(folded, pa.string()),
                "tree": rows["tree"],
                "position": pa.array([position(0, n, block["size"]) for n in numbers], pa.int64()),
            }
        )

    names = "leaf string, subroot string, root string"
    rest = T.StructType.fromDDL(
        f"{names}, {_STEPS.replace('steps', 'proof', 1)}, folded_root string, tree long, position long"
    )
    schema = T.StructType([made.leaves.schema["doc_id"], *rest.fields])
    grouped = leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
    return grouped.applyInArrow(extract, schema)


def log_nodes(made: Manifest) -> DataFrame:
    """The logs of all languages, a row per node: tree, position, level, index and digest."""

    def at(tier: Tier):
        def unroll(batches):
            for batch in batches:
                out = {name: [] for name in ("tree", "position", "level", "index", "digest")}
                for row in batch.to_pylist():
                    below = tier.below(row["size"], row["block"])
                    # What a builder starts from was written by the tier below, but for leaves.
                    for level in range(tier.number > 0, tier.levels(row["size"]) + 1):
                        first = row["block"] << (tier.step - level)
                        for k in range(-(-below >> level)):
                            place = (tier.number * tier.step + level, first + k)
                            out["tree"].append(row["tree"])
                            out["position"].append(position(*place, row["size"]))
                            out["level"].append(place[0])
                            out["index"].append(place[1])
                            out["digest"].append(row["log"][position(level, k, below)])
                yield pa.RecordBatch.from_pydict(out)

        return unroll

    kind = "tree long, position long, level long, index long, digest string"
    step = made.by_lang.step
    parts = [t.mapInArrow(at(Tier(k, step)), kind) for k, t in enumerate(made.by_lang.tiers)]
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.union(part)
    return nodes


def merkle_manifest(docs: DataFrame, step: int = BLOCK_LEVELS) -> DataFrame:
    """One row per document: its digest, the roots, and what folding its row, maybe tampered, gives."""
    made = manifest(docs, tampered_digest(), step)
    if made is None:
        kind = T.StructType.fromDDL(
            "leaf string, subroot string, root string, proof_sha256 string, folded_root string,"
            " verified boolean, position long"
        )
        schema = T.StructType([docs.schema["doc_id"], *kind.fields])
        return docs.sparkSession.createDataFrame([], schema)
    text = F.expr("array_join(transform(proof, s -> concat(s.left, s.right)), '')")
    return proofs(made).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(text, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        "position",
    )
