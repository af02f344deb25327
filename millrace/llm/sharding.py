"""Sharding by a hierarchical tree of weighted hash draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ROW, columns, gapless, with_row
from millrace.session import pin

# A tree is a nested dict: region -> rack -> shard -> weight. Shards are numbered in order.
Tree = dict[str, dict[str, dict[str, float]]]


def even_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> Tree:
    """Equal weights; 24 shards by default."""
    return {
        f"region{r}": {f"rack{k}": {f"shard{s}": 1.0 for s in range(shards)} for k in range(racks)}
        for r in range(regions)
    }


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, as a region of its own.

    Every level below the root keeps its weights, so rows move from the old regions into
    the new shard and nowhere else.
    """
    return tree | {f"region{len(tree)}": {"rack0": {"shard0": weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def _draw(key: Column, path: str, weight: float) -> Column:
    """Exponential waiting time of a node: the smallest of its siblings wins, in proportion to weight."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11) + 1) / F.lit(float(2**53))
    return -F.ln(uniform) / F.lit(weight)


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard number of a key: descend region, rack and shard, one weighted draw per level."""
    numbers = iter(range(10**9))

    def descend(node, path: str) -> Column:
        if not isinstance(node, dict):
            return F.lit(next(numbers))
        names = [n for n in node if _weight(node[n]) > 0]
        below = {n: descend(node[n], f"{path}/{n}") for n in node}
        if not names:
            raise ValueError(f"no weight below {path or 'the root'}")
        draws = [F.struct(_draw(key, f"{path}/{n}", _weight(node[n])), F.lit(i)) for i, n in enumerate(names)]
        won = F.array_min(F.array(*draws))["col2"] if len(names) > 1 else F.lit(0)
        out = below[names[-1]]
        for i in reversed(range(len(names) - 1)):
            out = F.when(won == i, below[names[i]]).otherwise(out)
        return out

    return descend(tree, "").cast("int")


def assign_shards(
    docs: DataFrame, tree: Tree | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deal documents to the shards of a tree by id.

    Only the id and the tree decide, so a changed weight moves rows into or out of the
    subtrees that hold it. Rows of one id, or all rows without id, share a shard. The size
    is the text's UTF-8 bytes plus 8, a NULL text has none. Slots number a shard's rows
    from 0 without gaps; repeated rows get slots of their own. An empty table gives no
    rows, further columns are ignored. Returns doc_id, size, text_crc32, law, shard, slot,
    grown_shard (the shard after ``grow``).
    """
    tree = tree or even_tree()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pin(with_row(columns(docs, doc_id=id_col, text=text_col)).select(
        "doc_id", ROW,
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), grow(tree)).alias("grown_shard"),
    ))
    return gapless(rows, "shard", [ROW], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
