"""Trees: neighbour joining, Newick text, rooting, clade names, child-parent relations."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tree_label

_UNSAFE = str.maketrans(" ()[]:,;'", "_________")


def join_neighbours(labels: list[str], dist) -> str:
    """The neighbour-joining tree of a distance matrix as Newick text.

    Of equal criteria the first pair in node order is joined; branches are at least 0; the last two nodes
    share their distance.
    """
    text = [str(x).translate(_UNSAFE) for x in labels]
    if not text:
        return ";"
    if len(text) == 1:
        return f"({text[0]}:0.0);"
    d = np.array(dist, float)
    while len(text) > 2:
        m = len(text)
        r = d.sum(axis=1)
        q = (m - 2) * d - r[:, None] - r[None, :]
        q[np.tril_indices(m)] = np.inf
        i, j = divmod(int(np.argmin(q)), m)
        half = 0.5 * d[i, j] + (r[i] - r[j]) / (2 * (m - 2))
        other = d[i, j] - half
        made = f"({text[i]}:{max(half, 0.0):.6f},{text[j]}:{max(other, 0.0):.6f})"
        new = 0.5 * (d[i] + d[j] - d[i, j])
        keep = [k for k in range(m) if k not in (i, j)]
        d = np.block([[d[np.ix_(keep, keep)], new[keep][:, None]], [new[keep][None, :], np.zeros((1, 1))]])
        text = [text[k] for k in keep] + [made]
    h = max(d[0, 1] / 2, 0.0)
    return f"({text[0]}:{h:.6f},{text[1]}:{h:.6f});"


def nj_tree(pairs: DataFrame, group: str | None = None, missing: float = 0.0) -> DataFrame:
    """(group, newick) from distances (a, b, d), each pair once or twice; one tree per group.

    Pairs that are not listed have the distance `missing`; a record may be listed with itself only.

    A tree needs its whole matrix at one place, so a group is bounded by what neighbour joining can do at
    all: representatives in the thousands. Groups are built side by side.
    """
    rows = pairs.select((F.col(group) if group else F.lit("")).cast("string").alias("grp"), F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.col("d").cast("double").alias("d"))

    def build(x: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(x["a"]) | set(x["b"]))
        at = {n: k for k, n in enumerate(names)}
        m = np.full((len(names), len(names)), missing)
        np.fill_diagonal(m, 0.0)
        i, j = x["a"].map(at).to_numpy(), x["b"].map(at).to_numpy()
        m[i, j] = m[j, i] = x["d"].to_numpy()
        return pd.DataFrame({"grp": [x["grp"].iloc[0]], "newick": [join_neighbours(names, m)]})

    return rows.groupBy("grp").applyInPandas(build, "grp string, newick string")


def nj_first_pair(pairs: DataFrame) -> DataFrame:
    """One row (a, b, q): the pair that neighbour joining joins first, in SQL alone; pairs: (a, b, d) both ways."""
    r = pairs.groupBy("a").agg(F.sum("d").alias("r"))
    n = r.agg(F.count("*").alias("n"))
    q = pairs.where("a < b").join(r.withColumnRenamed("r", "ra"), "a").join(r.withColumnsRenamed({"a": "b", "r": "rb"}), "b").join(F.broadcast(n))
    q = q.withColumn("q", F.round((F.col("n") - 2) * F.col("d") - F.col("ra") - F.col("rb"), 6))
    return q.orderBy("q", "a", "b").limit(1).select("a", "b", "q")


def read_newick(text: str) -> list[tuple[int, int, str, float | None]]:
    """(node, parent, label, length) in preorder; the root is node 0 with parent -1. Underscores stay."""
    nodes: list[list] = [[0, -1, "", None]]
    here, k, n = 0, 0, len(text)
    state = "label"
    while k < n:
        c = text[k]
        if c in "(,":
            parent = here if c == "(" else nodes[here][1]
            nodes.append([len(nodes), parent, "", None])
            here, state = len(nodes) - 1, "label"
        elif c == ")":
            here, state = nodes[here][1], "label"
        elif c == ":":
            state = "length"
        elif c == ";":
            break
        elif c == "[":
            k = text.index("]", k)
        elif c in " \t\r\n":
            pass
        elif c in "'\"":
            end = k + 1
            while text[end] != c or text[end + 1 : end + 2] == c:
                end += 2 if text[end] == c else 1
            nodes[here][2] = text[k + 1 : end].replace(c * 2, c)
            k = end
        else:
            end = k
            while end < n and text[end] not in "(),:;[ \t\r\n":
                end += 1
            if state == "length":
                nodes[here][3] = float(text[k:end])
            else:
                nodes[here][2] = text[k:end]
            k = end - 1
        k += 1
    return [tuple(x) for x in nodes]


def reroot(nodes: list[tuple], leaf: str) -> list[tuple]:
    """The same tree with its root moved to the parent of a leaf, which becomes the root's first child.

    A former root left with one child is removed and its branches are joined. An unknown leaf changes nothing.
    """
    parent = {i: p for i, p, _, _ in nodes}
    label = {i: x for i, _, x, _ in nodes}
    length = {i: x for i, _, _, x in nodes}
    kids: dict[int, list[int]] = {i: [] for i in parent}
    for i, p in parent.items():
        if p >= 0:
            kids[p].append(i)
    hit = next((i for i in parent if not kids[i] and label[i] == leaf), None)
    if hit is None or parent[hit] < 0:
        return nodes
    top, path = parent[hit], []
    at = top
    while parent[at] >= 0:
        path.append(at)
        at = parent[at]
    old = at
    for child in reversed(path):
        up = parent[child]
        kids[up].remove(child)
        kids[child].append(up)
        parent[up], length[up], parent[child] = child, length[child], -1
    length[top] = None
    if old != top and len(kids[old]) == 1:
        only, up = kids[old][0], parent[old]
        kids[up][kids[up].index(old)] = only
        parent[only] = up
        if length[only] is not None or length[old] is not None:
            length[only] = (length[only] or 0.0) + (length[old] or 0.0)
    kids[top].remove(hit)
    kids[top].insert(0, hit)
    out, todo, number = [], [(top, -1)], {}
    while todo:
        i, p = todo.pop()
        number[i] = len(out)
        out.append((number[i], -1 if p < 0 else number[p], label[i], length[i]))
        todo.extend((k, i) for k in reversed(kids[i]))
    return out


def tree_table(trees: DataFrame, text: str = "newick", outgroup: str | None = None) -> DataFrame:
    """(node, parent, label, length) of one Newick text per row, rooted at the outgroup leaf if given."""

    def run(batches):
        for b in batches:
            for t in b[text]:
                nodes = read_newick(t)
                yield pd.DataFrame(reroot(nodes, outgroup) if outgroup else nodes, columns=["node", "parent", "label", "length"]).astype({"length": "float64"})

    return trees.select(text).mapInPandas(run, "node int, parent int, label string, length double")


def ancestors(nodes: DataFrame) -> DataFrame:
    """(leaf, leaf_label, node, depth): all proper ancestors of each leaf; depth 1 is its parent.

    The paths double in length each round, so the rounds follow the logarithm of the depth.
    """
    from ..session import cut

    up = cut(nodes.where("parent >= 0").select("node", "parent"))
    leaves = nodes.join(nodes.select(F.col("parent").alias("node")).distinct(), "node", "left_anti").where("label != ''").select("node", "label")
    jump, step = up.select("node", F.col("parent").alias("far")), 1
    paths = leaves.join(up, "node").select(F.col("node").alias("leaf"), F.col("label").alias("leaf_label"), F.col("parent").alias("node"), F.lit(1).alias("depth"))
    paths = cut(paths)
    while True:
        more = paths.join(jump, "node").select("leaf", "leaf_label", F.col("far").alias("node"), (F.col("depth") + step).alias("depth"))
        more = cut(more)
        if more.isEmpty():
            return paths
        paths = cut(paths.unionByName(more).distinct())
        jump = cut(jump.join(jump.select(F.col("node").alias("far"), F.col("far").alias("farther")), "far").select("node", F.col("farther").alias("far")))
        step *= 2


def clade_names(nodes: DataFrame, basename: str | None = None, paths: DataFrame | None = None) -> DataFrame:
    """(node, name) of inner nodes: md5 of the sorted leaf labels joined by blanks, or basename and a preorder number; the root is 'root'.

    paths: of ancestors(nodes), if they are known already.
    """
    paths = ancestors(nodes) if paths is None else paths
    inner = paths.groupBy("node").agg(F.md5(F.array_join(F.sort_array(F.collect_list("leaf_label")), " ")).alias("hash"))
    named = inner.join(nodes.select("node", "parent"), "node")
    if basename is not None:
        from .compose import positions

        numbered = positions(named.where("parent >= 0").select("node"), "node")
        named = named.join(numbered, "node", "left").withColumn("hash", F.concat(F.lit(basename), F.col("pos").cast("string")))
    return named.select("node", F.when(F.col("parent") < 0, "root").otherwise(F.col("hash")).alias("name"))


def relations(nodes: DataFrame, basename: str | None = None, drop_leaf: str | None = None, root_name: str = "root") -> DataFrame:
    """(child, parent) edges of the named tree, each once; drop_leaf and nodes above it alone go."""
    used = ancestors(nodes)
    names = clade_names(nodes, basename, used)
    keep = nodes if drop_leaf is None else nodes.where(F.col("label") != drop_leaf)
    used = used if drop_leaf is None else used.where(F.col("leaf_label") != drop_leaf)
    inner = used.select("node").distinct()
    label = names.join(inner, "node", "left_semi").withColumn("name", F.when(F.col("name") == "root", root_name).otherwise(F.col("name")))
    leaves = used.select(F.col("leaf").alias("node"), F.col("leaf_label").alias("name")).distinct()
    everyone = label.unionByName(leaves)
    edges = keep.where("parent >= 0").select("node", "parent").join(everyone.withColumnRenamed("name", "child"), "node")
    return edges.join(everyone.select(F.col("node").alias("parent"), F.col("name").alias("up")), "parent").select("child", F.col("up").alias("parent")).distinct()


def genome_map(leaves: DataFrame, clusters: DataFrame) -> DataFrame:
    """(accession, leaf): each leaf's own accession and those of the members its representative stands for.

    leaves: (leaf); clusters: (representative, member) as file names.
    """
    from ..functions import names

    own = leaves.select(F.col("leaf"), F.col("leaf").alias("name"))
    under = clusters.where("representative != member").select(names.strip_suffix(F.col("representative")).alias("leaf"), names.strip_suffix(F.col("member")).alias("name"))
    all_ = own.unionByName(under.join(leaves, "leaf", "left_semi"))
    return all_.select(names.parse_file_name(F.col("name"))["accession"].alias("accession"), "leaf").distinct()


def clade_hash(labels: list[str]) -> str:
    return hashlib.md5(" ".join(sorted(labels)).encode()).hexdigest()


__all__ = ["tree_label", "join_neighbours", "nj_tree", "nj_first_pair", "read_newick", "reroot", "tree_table", "ancestors", "clade_names", "relations", "genome_map", "clade_hash"]
