"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets.

Two small collections, A and B, of `side` hashes each are made from `side * width` minhashes apiece. Table (i, j) is keyed by
the pair (A_i, B_j), so side**2 tables of 2 * width minhashes come out of 2 * side * width minhashes. Two documents of
similarity s share a table unless A or B has no hash in common: with the defaults, 2 * (1 - 0.85**3)**10, or about one pair in
7,000 at exactly 0.85, one in 230,000 at 0.9, and one in 10**10 at 0.97.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.components import components
from chartlake.llm.tables import by_group, by_text, release, saved, slices
from chartlake.llm.words import U, mixed, seeds, windows, word_hashes

SHINGLE = 5
SIDE = 10
WIDTH = 3
#: Shingles that one verification task holds for each of its two parts, unless one document alone has more.
PART_SHINGLES = 500_000
#: Documents that it holds for each part.
PART_MEMBERS = 1_000
#: Shingles of candidates looked at at once for one document.
COUNT_AT_ONCE = 1_000_000


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct word shingles, as 64-bit hashes; A-Z are folded.

    A text of fewer than size words has its whole word sequence as the only one; a text without words has none.
    """
    words, at = word_hashes(texts, lower=True)
    every = windows(words, size)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            out.append(np.unique(every[a : b - size + 1]))
        else:
            out.append(windows(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def collections(sets: list[np.ndarray], side: int, width: int) -> np.ndarray:
    """2 * side hashes of width minhashes for each set that isn't empty: collection A, then B."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
    out = np.zeros((len(sets), 2 * side), np.uint64)
    factors, mixes = seeds(2 * side * width, 5000), seeds(width, 9000)
    for k in range(2 * side * width):
        out[:, k // width] += np.minimum.reduceat(joined * factors[k], starts) * mixes[k % width]
    return mixed(out)


def _signatures(size: int, side: int, width: int):
    def kernel(texts: list[str]) -> list[list]:
        sets = shingle_sets([x.encode() for x in texts], size)
        full = [k for k, x in enumerate(sets) if len(x)]
        bands: list = [None] * len(sets)
        if full:
            for k, row in zip(full, collections([sets[k] for k in full], side, width).view(np.int64)):
                bands[k] = row
        # Two sums over the set, mixed in different ways, name it.
        names = [[int(np.sum(mixed(x + U(c)), dtype=np.uint64).view(np.int64)) for x in sets] for c in (11, 23)]
        return [[len(x) for x in sets], *names, bands]

    return kernel


SIGNATURE = [
    T.StructField("n_shingles", T.LongType()), T.StructField("_s1", T.LongType()), T.StructField("_s2", T.LongType()),
    T.StructField("_bands", T.ArrayType(T.LongType())),
]


def candidate_edges(classes: DataFrame, side: int) -> DataFrame:
    """(a, b): members of a shared table and the table's smallest member. A document without a shared A or B hash is in none."""
    values = classes.select("rep", F.posexplode("_bands").alias("k", "v"))
    shared = values.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1").select("k", "v")
    own = values.join(shared, ["k", "v"], "left_semi").groupBy("rep").agg(F.collect_list(F.struct("k", "v")).alias("own"))
    # At most side hashes on either side, so the pairs of a document are bounded.
    tables = (
        own.select(
            "rep",
            F.expr(f"filter(own, x -> x.k < {side})").alias("a"),
            F.expr(f"filter(own, x -> x.k >= {side})").alias("b"),
        )
        .select("rep", "b", F.explode("a").alias("a"))
        .select("rep", "a", F.explode("b").alias("b"))
        .select("rep", F.xxhash64("a.k", "a.v", "b.k", "b.v").alias("table"))
    )
    tables = saved(tables, "tables")
    heads = tables.groupBy("table").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last")
    return (
        tables.join(heads.select("table", "head"), "table")
        .where("rep <> head")
        .select(F.col("rep").alias("a"), F.col("head").alias("b"))
        .distinct()
    )


def linked(nodes: np.ndarray, sets: list[np.ndarray], percent: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between these sets (none empty): pairs with 100 * intersection >= percent * union.

    A partner of a set of n shingles shares ceil(percent * n / 100) of them at least, so with shingles ordered from the rarest on,
    two linked sets have one in common among their first n - ceil(percent * n / 100) + 1. Posting lists hold these alone; whoever
    meets there is confirmed on full sets, unless known labels or earlier links already put the two together.
    """
    n, lengths = len(sets), np.array([len(x) for x in sets])
    owner, at = np.repeat(np.arange(n), lengths), np.concatenate([[0], np.cumsum(lengths)])
    _, term, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rarity = np.empty(len(df), np.int64)
    rarity[np.argsort(df, kind="stable")] = np.arange(len(df))
    term = rarity[term]
    term = term[np.lexsort((term, owner))]
    least = -(-percent * lengths // 100)
    early = np.arange(len(term)) - at[owner] <= (lengths - least)[owner]
    early_term, early_at = term[early], np.concatenate([[0], np.cumsum(np.bincount(owner[early], minlength=n))])
    held_by = np.bincount(early_term, minlength=len(df))
    first = np.concatenate([[0], np.cumsum(held_by)])
    postings = owner[early][np.argsort(early_term, kind="stable")]
    label = np.arange(n) if known is None else np.unique(known, return_inverse=True)[1]
    classes: dict[int, list[int]] = {}
    for k, c in enumerate(label.tolist()):
        classes.setdefault(c, []).append(k)

    def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)

    edges, own = [], np.zeros(len(df), bool)
    for x in range(n):
        met = early_term[early_at[x] : early_at[x + 1]]
        near = postings[ranges(first[met], held_by[met])]
        near = np.unique(near[(near > x) & (label[near] != label[x])])
        near = near[100 * np.minimum(lengths[near], lengths[x]) >= percent * np.maximum(lengths[near], lengths[x])]
        if not len(near):
            continue
        own[term[at[x] : at[x + 1]]] = True
        for a, b in slices(lengths[near].tolist(), COUNT_AT_ONCE):
            some = near[a:b]
            sizes = lengths[some]
            shared = np.add.reduceat(own[term[ranges(at[some], sizes)]], np.cumsum(sizes) - sizes, dtype=np.int64)
            for y in some[100 * shared >= percent * (sizes + lengths[x] - shared)].tolist():
                if label[y] != label[x]:
                    edges.append((int(nodes[x]), int(nodes[y])))
                    small, large = sorted((int(label[x]), int(label[y])), key=lambda c: len(classes[c]))
                    moved = classes.pop(small)
                    label[moved] = large
                    classes[large] += moved
        own[term[at[x] : at[x + 1]]] = False
    return edges


def _verify(percent: int):
    def run(rows: pa.Table) -> list:
        # Rows of one document id are one node, so an id may bring several sets.
        nodes, label = rows["rep"].to_numpy(), rows["label"]
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        edges = linked(nodes, sets, percent, None if label.null_count else label.to_numpy())
        return [[x for x, _ in edges], [y for _, y in edges]]

    return run


def _sets(size: int):
    def kernel(texts: list[str]) -> list[list]:
        return [[x.tobytes() for x in shingle_sets([t.encode() for t in texts], size)]]

    return kernel


def _parts(shingles: Column, members: Column) -> Column:
    return F.greatest(F.ceil(shingles / PART_SHINGLES), F.ceil(members / PART_MEMBERS)).cast("long")


def verified_edges(members: DataFrame, percent: int) -> DataFrame:
    """Spanning edges of the true links inside candidate groups; members: (rep, grp, n_shingles, shingles binary).

    A group is cut into parts of bounded total size and number of members. One round of tasks compares part 0 and each other part, in themselves and
    with each other, so what a task holds and the number of copies stay in proportion to the group. What is then still apart
    from its group's largest class is compared with the group's other parts in a second round; the copies are as many as such
    documents' parts times the group's parts. Nothing is left out: any two members either are in one class after the first
    round, or meet in a task of one of the rounds.
    """
    sizes = members.groupBy("grp").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("of"))
    parts = _parts(F.col("total"), F.col("of"))
    dealt = saved(
        members.join(sizes.where("of > 1"), "grp").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("rep"), "parts")),
        "dealt",
    ).drop("total", "of")
    task = F.when(F.col("part") == 0, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("part"))
    first = (
        dealt.withColumn("task", F.explode(task))
        .select("grp", "task", "rep", "shingles", F.lit(None).cast("long").alias("label"))
    )
    first = saved(by_group(first, ["grp", "task"], "a long, b long", _verify(percent)), "links")
    large = dealt.where("parts > 2")
    if large.isEmpty():
        return first
    classes = components(first)
    labelled = large.join(classes.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")
    counts = labelled.groupBy("grp", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("grp").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"))
    apart = labelled.join(main, "grp").where("label <> main").drop("main")
    cuts = apart.groupBy("grp").agg(_parts(F.sum("n_shingles"), F.count("*")).alias("cuts"))
    left = (
        apart.join(cuts, "grp")
        .withColumn("cut", F.pmod(F.xxhash64("rep"), "cuts"))
        .withColumn("part", F.explode(F.expr("sequence(1, parts - 1)")))
    )
    right = labelled.where("part > 0").join(cuts, "grp").withColumn("cut", F.explode(F.expr("sequence(0, cuts - 1)")))
    columns = ["grp", "cut", "part", "rep", "shingles", "label"]
    second = left.select(columns).union(right.select(columns))
    return first.union(saved(by_group(second, ["grp", "cut", "part"], "a long, b long", _verify(percent)), "links"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85, size: int = SHINGLE, side: int = SIDE, width: int = WIDTH
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of docs.

    Texts with the same shingle set form a class, of which only one member goes on. Classes that share a table form candidate
    groups; links inside a group are confirmed on full sets (100 * intersection >= percent * union), and component_id is the
    smallest id reachable over confirmed links.

    Null, empty and blank texts have no shingles and stand alone. Rows with the same id count as one document, whose texts are
    linked. A null id takes no part: its component_id is null and it is kept. An empty table gives an empty result. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = saved(by_text(plain, "text", SIGNATURE, _signatures(size, side, width)), "signatures")
    filled = signed.where("n_shingles > 0 and id is not null")
    classes = saved(
        filled.groupBy("_s1", "_s2").agg(F.min("id").alias("rep"), F.first("_bands").alias("_bands"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    # Copies hang on their class's smallest id; an id whose rows differ ties its classes together.
    copies = filled.join(classes.select("_s1", "_s2", "rep"), ["_s1", "_s2"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    copies = saved(copies.distinct(), "copies")
    edges = saved(candidate_edges(classes, side), "candidates")
    release(spark)
    groups = components(edges)
    grouped = groups.select(F.col("node").alias("rep"), F.col("component").alias("grp")).union(
        groups.select(F.col("component").alias("rep"), F.col("component").alias("grp")).distinct()
    )
    texts = plain.join(grouped, plain["id"] == grouped["rep"]).select("rep", "grp", "text")
    members = by_text(texts, "text", [T.StructField("shingles", T.BinaryType())], _sets(size))
    members = saved(members.withColumn("n_shingles", F.length("shingles") / 8).where("n_shingles > 0"), "sets")
    release(spark)
    links = verified_edges(members, percent).union(copies)
    found = components(links)
    release(spark)
    out = signed.join(found, signed["id"] == found["node"], "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id), F.col("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
