"""Merkle manifest of a dataset: one tree a language over its documents in the order of doc_id, and one over their roots.

Every FANOUT consecutive nodes of a level become one, the last ones of a level fewer and without padding, until one is
left. Leaves are numbered by dealing them to ranges of their order (operators.ordered), so each partition holds a stretch of
consecutive leaves of a language. It runs a mountain-range stack over them: the stack holds the open run of each level; a
run that fills up is carried to the level above as one node, which is recorded. A partition need not begin or end at a
multiple of FANOUT: the nodes of runs that reach beyond it are its edges, FANOUT - 1 a level and side at most. Edges of
neighbouring partitions are merged level by level. The trees of all languages have their roots put in order and go the
same way, as leaves of a tree of their own.

Proofs go down from the root: a block of FANOUT ** STRIDE neighbouring nodes meets the path above it, one row, and gives
each of its nodes the path from there. So a group is at most that many digests, whatever the size of a language.

Defined results: a null in a column is hashed as `-`; null doc_ids come first in their language and count as the empty
string where a number decides what is tampered with; rows of one doc_id stand in the order of their leaves, equal rows in
any, which gives the same digests; empty texts have zero bytes; very long texts are hashed whole; an empty table has no
rows and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import crc32_sql, lower_az, read, remainder, stored

FANOUT = 8
#: Levels that a block of a proof climbs.
STRIDE = 3
TAMPER = 3
NODE, EDGE, ROOT = 0, 1, 2
NODES = "tree string, total bigint, level int, at bigint, digest string, kind int"
PATHS = "tree string, block bigint, left array<string>, right array<string>"
PROOFS = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, text: Column) -> Column:
    parts = [docs["doc_id"].cast("long"), docs["source"], docs["lang"], docs["n_chars"].cast("long"), text]
    return F.sha2(F.concat(*map(field, parts)).cast("binary"), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, tampered: the leaf of the text in lower case where the row's number says so, else null."""
    tree = F.coalesce(F.concat(F.lit("="), docs["lang"]), F.lit(""))  # null comes first and is not the empty name
    other = F.when(remainder(docs["doc_id"], TAMPER) == 0, leaf_digest(docs, lower_az(docs["text"])))
    return docs.select(tree.alias("tree"), docs["doc_id"].cast("long").alias("doc_id"), leaf_digest(docs, docs["text"]).alias("leaf"), other.alias("tampered"))


def joined_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def count_at(total: int, level: int) -> int:
    """Nodes of a level."""
    return -(-total // FANOUT**level)


def depth(total: int) -> int:
    level = 0
    while count_at(total, level) > 1:
        level += 1
    return level


class Stack:
    """The open runs of one tree, a list a level, over consecutive leaves."""

    def __init__(self, tree: str, total: int) -> None:
        self.tree, self.total, self.next = tree, total, None
        self.counts = [count_at(total, level) for level in range(depth(total) + 1)]
        self.firsts, self.held = [0] * len(self.counts), [[] for _ in self.counts]

    def push(self, at: int, digest: str) -> Iterator[tuple]:
        """Adds a leaf and yields the nodes that it completes, or edges where a run began before this partition."""
        self.next = at + 1
        for level, count in enumerate(self.counts):
            held = self.held[level]
            if not held:
                self.firsts[level] = at
            held.append(digest)
            if count == 1:
                held.clear()
                yield self.tree, self.total, level, 0, digest, ROOT
                return
            if at + 1 < count and (at + 1) % FANOUT:
                return  # the run goes on
            if self.firsts[level] % FANOUT:
                yield from self.open_run(level)
                return
            at, digest = at // FANOUT, joined_digest(held)
            held.clear()
            yield self.tree, self.total, level + 1, at, digest, NODE

    def open_run(self, level: int) -> Iterator[tuple]:
        for number, digest in enumerate(self.held[level]):
            yield self.tree, self.total, level, self.firsts[level] + number, digest, EDGE
        self.held[level].clear()

    def edges(self) -> Iterator[tuple]:
        for level in range(len(self.counts)):
            yield from self.open_run(level)


def record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32()]
    names = [part.split()[0] for part in NODES.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def stacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, edges and roots of a partition's stretches. Where leaves do not follow each other, a new stack begins, so the
    result holds for any order; consecutive ones give few edges."""
    stack = None
    for batch in batches:
        out: list[tuple] = []
        for tree, total, at, digest in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if stack is None or stack.tree != tree or stack.next != at:
                if stack is not None:
                    out += stack.edges()
                stack = Stack(tree, total)
            out += stack.push(at, digest)
        yield record_batch(out)
    if stack is not None:
        yield record_batch(list(stack.edges()))


def merged(pieces: DataFrame) -> DataFrame:
    """All nodes and roots: those of the pieces, and those that edges of neighbouring partitions complete. One pass a
    level; a group is one run."""
    edges = pieces.where(F.col("kind") == EDGE).drop("kind")
    most = edges.agg(F.max("total")).first()[0] or 0
    found, carried = pieces.where(F.col("kind") != EDGE), None
    for level in range(depth(most)):
        here = edges.where(F.col("level") == level)
        here = here if carried is None else here.unionByName(carried.where(F.col("kind") == NODE).drop("kind"))
        runs = here.groupBy("tree", "total", F.floor(F.col("at") / FANOUT).alias("run")).agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("held"))
        nodes = lambda up: F.ceil(F.col("total") / F.lit(FANOUT**up)).cast("long")
        whole = F.size("held") == F.least(F.lit(FANOUT), nodes(level) - F.col("run") * FANOUT)
        digest = F.sha2(F.concat_ws("", F.transform("held", lambda x: x["digest"])).cast("binary"), 256)
        up = runs.select("tree", "total", F.lit(level + 1).alias("level"), F.col("run").alias("at"), F.when(whole, digest).otherwise(F.raise_error(F.lit("a run lacks nodes"))).alias("digest"))
        # a root is a record of its own beside the node, as in the stack
        carried = stored(up.withColumn("kind", F.explode(F.when(nodes(level + 1) == 1, F.array(F.lit(NODE), F.lit(ROOT))).otherwise(F.array(F.lit(NODE))))), "runs")
        found = found.unionByName(carried)
        carried = carried.where(nodes(level + 1) > 1)
    return found


def climbed(members: pa.Table, above: pa.Table, low: int) -> tuple[pa.Table, list[tuple[list[str], list[str]]]]:
    """A block's members in their order, and for each the siblings to its left and right, level by level to the root."""
    members = members.sort_by("at")
    places, total = members.column("at").to_pylist(), members.column("total")[0].as_py()
    first = places[0] - places[0] % FANOUT**STRIDE
    if places != list(range(first, first + len(places))) or above.num_rows != 1:
        raise ValueError("a block lacks nodes")
    nodes, own = members.column("digest").to_pylist(), list(range(len(places)))
    paths: list[tuple[list[str], list[str]]] = [([], []) for _ in own]
    for _ in range(min(STRIDE, depth(total) - low)):
        sides = []
        for at in range(len(nodes)):
            run = at - at % FANOUT
            sides.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + FANOUT])))
        for path, at in zip(paths, own, strict=True):
            path[0].append(sides[at][0])
            path[1].append(sides[at][1])
        own = [at // FANOUT for at in own]
        nodes = [joined_digest(nodes[run : run + FANOUT]) for run in range(0, len(nodes), FANOUT)]
    left, right = above.column("left")[0].as_py(), above.column("right")[0].as_py()
    return members, [(path[0] + left, path[1] + right) for path in paths]


def path_table(names: list[str], members: pa.Table, paths: list, column: str) -> pa.Table:
    texts = pa.list_(pa.string())
    sides = [pa.array([path[side] for path in paths], texts) for side in (0, 1)]
    return pa.table(dict(zip(names, [members.column(column), *sides], strict=True)))


def path_rows(low: int):
    def rows(members: pa.Table, above: pa.Table) -> pa.Table:
        members, paths = climbed(members, above, low)
        return path_table(["block", "left", "right"], members, paths, "at").add_column(0, "tree", members.column("tree"))

    return rows


def folded(digest: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in zip(left, right, strict=True):
        digest = joined_digest([before, digest, after])
    return digest


def subroot_paths(members: pa.Table, above: pa.Table) -> pa.Table:
    members, paths = climbed(members, above, 0)
    return path_table(["tree", "left", "right"], members, paths, "name")


def proof_rows(members: pa.Table, above: pa.Table) -> pa.Table:
    members, paths = climbed(members, above, 0)
    leaves, levels = members.column("digest").to_pylist(), depth(members.column("total")[0].as_py())
    subroot = folded(leaves[0], *(side[:levels] for side in paths[0]))
    proofs = [joined_digest([x for pair in zip(*path, strict=True) for x in pair]) for path in paths]
    shown = [other or leaf for other, leaf in zip(members.column("tampered").to_pylist(), leaves, strict=True)]
    again = [folded(leaf, *path) for leaf, path in zip(shown, paths, strict=True)]
    return pa.table({"doc_id": members.column("doc_id"), "leaf": members.column("digest"), "subroot": pa.array([subroot] * len(leaves), pa.string()), "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(again, pa.string())})


class Forest:
    """Trees over rows (tree, digest, ...): rows with their number `at` and their tree's `total`; nodes above the leaves;
    roots, one row a tree."""

    def __init__(self, rows: DataFrame, digest: str, *order: Column) -> None:
        self.rows = numbered(rows, ["tree"], *order, name="at", total="total")
        self.digest = digest
        with_kind = stored(merged(stored(self.rows.select("tree", "total", "at", digest).mapInArrow(stacked, NODES), "pieces")), "nodes")
        self.nodes = with_kind.where(F.col("kind") == NODE).drop("kind")
        self.roots = with_kind.where(F.col("kind") == ROOT).select("tree", "total", F.col("digest").alias("root"))

    def levels(self) -> list[int]:
        """The lowest level of each stride, from the top."""
        most = self.roots.agg(F.max("total")).first()[0] or 0
        return list(range(0, max(depth(most), 1), STRIDE))[::-1]

    def proofs(self, tops: DataFrame, finish, schema: str, *columns: str) -> DataFrame:
        """finish's rows for every leaf. tops: tree, left, right, the path above each root. finish takes the columns of a
        block's leaves, their paths, and gives a table of the schema; leaves come with the named columns."""
        above = None
        tops = stored(tops.join(self.roots, "tree"), "tops")
        for low in self.levels():
            reach = F.col("total") <= FANOUT ** (low + STRIDE)
            own = tops.where(reach & (F.col("total") > FANOUT**low) if low else reach).select("tree", F.lit(0).cast("long").alias("block"), "left", "right")
            above = own if above is None else above.unionByName(own)
            block = F.floor(F.col("at") / FANOUT**STRIDE).alias("block")
            if low:
                members = self.nodes.where((F.col("level") == low) & (F.col("total") > FANOUT**low)).select("tree", block, "at", "total", "digest")
                met = members.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
                above = met.applyInArrow(path_rows(low), PATHS)
        members = self.rows.select("tree", block, "at", "total", F.col(self.digest).alias("digest"), *columns)
        return members.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(finish, schema)


class Manifest:
    """languages: the forest of the documents' trees. top: the tree of their roots. root: None without documents."""

    def __init__(self, docs: DataFrame) -> None:
        leaves = stored(leaves_of(docs), "leaves").withColumn("row", F.monotonically_increasing_id())
        self.languages = Forest(leaves, "leaf", F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("row").asc())
        roots = stored(self.languages.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "root"), "roots")
        self.top = Forest(roots, "root", F.col("name").asc())
        found = self.top.roots.first()
        self.root = found["root"] if found else None

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, proof_sha256, folded_root of every document."""
        spark = self.top.nodes.sparkSession
        none = spark.createDataFrame([("", [], [])], "tree string, left array<string>, right array<string>")
        paths = self.top.proofs(none, subroot_paths, "tree string, left array<string>, right array<string>", "name")
        return self.languages.proofs(paths, proof_rows, PROOFS, "doc_id", "tampered")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = Manifest(read(spark, sf_dir, "documents"))
    root = F.lit(manifest.root).cast("string")
    return manifest.proofs().select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


#: Levels that the SQL spells out: enough for 8 ** 7 documents of a language and 8 ** 7 languages.
SQL_LEVELS = 7


def field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || ({value}::VARCHAR), '-')"


def leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(field_sql, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def levels_sql(name: str) -> str:
    """From name0 (row, tree, spot, n, digest, path, now) one table a level: digest is the node above the row, n the nodes of
    its level, path the siblings so far, now what the row's shown leaf folds to."""
    out = ""
    for level in range(SQL_LEVELS):
        here = f"{name}{level}"
        sides = "array_to_string(held[1:spot % 8], '')", "array_to_string(held[spot % 8 + 2:8], '')"
        out += f"""
{here}r AS MATERIALIZED (SELECT tree, spot // 8 AS run, sha256(string_agg(digest, '' ORDER BY spot)) AS up, list(digest ORDER BY spot) AS held FROM (SELECT DISTINCT tree, spot, digest FROM {here} WHERE n > 1) GROUP BY ALL),
{name}{level + 1} AS MATERIALIZED (SELECT row, tree, spot // 8 AS spot, (n + 7) // 8 AS n, up AS digest, path || {sides[0]} || {sides[1]} AS path, sha256({sides[0]} || now || {sides[1]}) AS now
  FROM {here} JOIN {here}r USING (tree) WHERE n > 1 AND run = spot // 8 UNION ALL SELECT * FROM {here} WHERE n = 1),"""
    return out


SQL = f"""
WITH leaves AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS tree, {leaf_sql("text")} AS leaf,
  CASE WHEN doc_id IS NULL OR {crc32_sql('doc_id::VARCHAR')} % {TAMPER} = 0 THEN {leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf_sql("text")} END AS shown FROM documents),
l0 AS MATERIALIZED (SELECT row, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest, '' AS path, shown AS now FROM leaves),{levels_sql("l")}
t0 AS MATERIALIZED (SELECT row, '' AS tree, dense_rank() OVER (ORDER BY encode(tree)) - 1 AS spot, (SELECT count(DISTINCT tree) FROM leaves) AS n, digest, path, now FROM l{SQL_LEVELS}),{levels_sql("t")}
subs AS (SELECT row, digest AS subroot FROM l{SQL_LEVELS})
SELECT doc_id, leaf, subroot, digest AS root, sha256(path) AS proof_sha256, now AS folded_root, now = digest AS verified FROM leaves JOIN subs USING (row) JOIN t{SQL_LEVELS} USING (row)
"""
