"""Merkle manifest of a table: leaves, subtrees for each language, inclusion proofs and their verification.

A row's leaf hashes its fields, each ``-`` if null, else its UTF-8 length, ``:`` and its value. Within a language the
leaves ascend by id; while several nodes remain, each run of eight consecutive ones becomes the hash of its digests. The
languages' subroots, in bytewise order (null first), are reduced likewise to the root.

One level is one window: lag and lead columns at the fixed offsets 1 to 7 give every node its neighbours; a neighbour
counts where the node's slot (place modulo 8) and its run's length say that both share a run. The masked columns joined
left and right of a node are its siblings, and the rows of slot 0 hash their run to the next level's node. A window
partition is one block of ``BLOCK`` consecutive places, which holds whole runs only, so a language with a third of all rows is
many partitions. Levels shrink by eight and are written once each; proofs then go down again, each node taking its
parent's path after its own siblings.

Places within a language come from a range partition (``places.placed``), so no task sorts a whole language. The only
things on the driver are the number of leaves of the largest group and the root.

Defined results: repeated rows are leaves of their own, side by side; equal ids are ordered by leaf; null ids come first
and are never tampered with; a lone leaf is its language's subroot and a lone subroot the root, without a hash; a proof
without siblings is the hash of nothing; an empty table has no rows and no root; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder, saved
from .places import joined, placed

ARITY = 8
#: Consecutive places in one window partition: a power of ARITY, so that no run is cut.
BLOCK = ARITY ** 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def with_siblings(nodes: DataFrame, group: Sequence[str]) -> DataFrame:
    """``nodes`` (group, pos, n, digest) with ``left`` and ``right``: the joined digests of the run's other nodes."""
    order = Window.partitionBy(*group, F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % ARITY
    length = F.least(F.lit(ARITY).cast("long"), F.col("n") - F.col("pos") + slot)
    back = [F.when(slot >= j, F.lag("digest", j).over(order)) for j in range(ARITY - 1, 0, -1)]
    ahead = [F.when(slot + j < length, F.lead("digest", j).over(order)) for j in range(1, ARITY)]
    return nodes.select("*", F.concat_ws("", *back).alias("left"), F.concat_ws("", *ahead).alias("right"))


def levels(nodes: DataFrame, group: Sequence[str], name: str) -> list[DataFrame]:
    """All levels of the groups' trees from ``nodes`` (group, pos, n, digest, ...) up, each with left and right."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = [saved(with_siblings(nodes, group), f"{name}-0")]
    while most > 1:
        parents = out[-1].filter((F.col("n") > 1) & (F.col("pos") % ARITY == 0)).select(
            *group, F.floor(F.col("pos") / ARITY).cast("long").alias("pos"),
            F.ceil(F.col("n") / ARITY).cast("long").alias("n"), digest(F.col("digest"), F.col("right")).alias("digest"))
        out.append(saved(with_siblings(parents, group), f"{name}-{len(out)}"))
        most = -(-most // ARITY)
    return out


def tops(tree: list[DataFrame], group: Sequence[str]) -> DataFrame:
    """The last node of each group: (group, digest)."""
    found = [level.filter("n = 1").select(*group, "digest") for level in tree]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def paths(tree: list[DataFrame], group: Sequence[str], above: DataFrame | None, name: str) -> DataFrame:
    """The lowest level with ``path``: (left, right) of every node from it to its group's top, then what ``above`` says.

    ``above`` holds one row for each group: its columns and ``path`` from the group's top on; other columns of it are
    handed down too. Without ``above`` a path ends at the top.
    """
    extra = [c for c in above.columns if c not in group and c != "path"] if above else []
    own = F.array(F.struct("left", "right")).cast(_PATH)
    upper = None
    for k in range(len(tree) - 1, -1, -1):
        level = tree[k]
        top = level.filter("n = 1")
        done = joined(top, above, group) if above else top.withColumn("path", F.array().cast(_PATH))
        if upper is not None:
            low = level.filter("n > 1").withColumn("_up", F.floor(F.col("pos") / ARITY).cast("long"))
            high = upper.select(*group, F.col("pos").alias("_up"), F.col("path").alias("_rest"), *extra)
            done = joined(low, high, ["_up", *group]).withColumn("path", F.concat(own, "_rest")).select(
                *done.columns).unionAll(done)
        upper = saved(done.select(*group, "pos", "path", *extra), f"{name}-{k}") if k else done
    return upper


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda below, p: F.sha2(F.concat(p["left"], below, p["right"]).cast("binary"), 256))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id",
             offered: Sequence[Column] | None = None) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified, and the proof itself (path).

    ``offered``: the fields whose leaf is checked against the manifest by its proof (default: the row itself).
    """
    given = [F.col(f) for f in fields]
    rows = saved(docs.select(
        F.col(key).alias("id"), F.col(group).alias("grp"), leaf(given).alias("digest"),
        leaf(offered or given).alias("offered"), F.monotonically_increasing_id().alias("uid")), "merkle-leaves")
    nodes = placed(rows, ["grp"], ["id", "digest", "uid"], "merkle-places").drop("uid")
    tree = levels(nodes, ["grp"], "merkle-level")
    subroots = saved(tops(tree, ["grp"]), "merkle-subroots")
    crown = levels(placed(subroots.withColumn("all", F.lit(0)), ["all"], ["grp"], "merkle-groups"), ["all"], "merkle-crown")
    last = tops(crown, ["all"]).first()
    root = F.lit(last["digest"] if last else None).cast("string")
    above = saved(paths(crown, ["all"], None, "merkle-crown-path").select(
        "grp", "path", F.col("digest").alias("subroot")), "merkle-above")
    proven = paths(tree, ["grp"], above, "merkle-path").withColumn("folded", fold(F.col("offered"), F.col("path")))
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    return proven.select(
        F.col("id").alias(key), F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"), "path")


def tampered(key: str = "doc_id", fields: Sequence[str] = FIELDS) -> list[Column]:
    """The fields as a tampering hand would offer them: where 3 divides the id's crc32, the text's A-Z are lower-case."""
    upper = "".join(map(chr, range(65, 91)))
    text = F.when(id_remainder(key, 3) == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    return [text if f == "text" else F.col(f) for f in fields]
