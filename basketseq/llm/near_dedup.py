"""Near-duplicate documents by a chosen-path similarity join on word shingles.

1. Documents of one shingle set are one class; all that follows works on
   classes, so thousands of copies cost as much as one text.
2. Each class carries minwise tokens: the smallest hash of its set under each
   of ``TOKENS`` hash functions. Two sets share a token with a probability equal
   to their similarity.
3. Independent trees branch the classes by chosen tokens. The choice depends on
   the node alone, so each class finds its own way down without a look at the
   others. The first ``START_DEPTH`` levels are taken at once. Nodes with the same
   members in several trees are looked at once where they are compared exhaustively;
   those that branch stay apart, since their repeats are the independent trials that
   recall rests on.
4. A small node (``LEAF`` members, ``LEAF_LOAD`` of text) is compared exhaustively,
   on the full sets, within one task; only the links that hold its parts together leave the task.
   Of larger nodes each member is compared with the smallest one at first. What
   all this links is contracted to components.
5. Large nodes that still hold two components or more are compared exhaustively,
   too, in pairs of blocks, where they have at most ``BLOCKS`` of them: that takes
   fewer copies of a member than branching does. Larger ones branch on, each by two
   tokens of its own, so that a pair at the threshold survives each level more than
   once on average (2 * 0.8 > 1). At ``MAX_DEPTH`` all that is left is compared in
   blocks, however many.

Trees are repeated until a pair exactly at the threshold is missed with a
probability below 1 - ``RECALL``, also where all its nodes stay large down to
``MAX_DEPTH`` (see ``trees_needed``); pairs above it are missed less often. Every
link is confirmed on full sets (64-bit shingle hashes).

Defined results: a null text, an empty text and one without words have an empty
set and link with nothing. A text of fewer words than a shingle is one shingle.
Repeated rows are documents of their own. The id of a component is the smallest
non-null id in it; a null id is an id of no rank. Other columns pass through,
also where their names equal a result column's (the result replaces them).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from basketseq.llm.components import components
from basketseq.llm.scratch import Scratch
from basketseq.llm.words import LOWER_ASCII, mixed, shingle_set, utf8

TOKENS = 96
START_DEPTH = 3
MAX_DEPTH = 8
#: A node is small, and compared within one task, up to this many members and
#: this much load: shingles of its members (8 bytes each), or eighths of their
#: texts' bytes where that is more (few long words, the same words over and over).
LEAF = 1_024
LEAF_LOAD = 1 << 20
#: Blocks (half a small node each) up to which a large node is compared at once. Each
#: member is copied for every other block; branching down would copy it twice a level.
BLOCKS = 8
RECALL = 0.999999

_RANDOM = np.random.default_rng(977)
_MULTIPLY = _RANDOM.integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 2**63, TOKENS, dtype=np.uint64)
RESULT_COLUMNS = ("n_shingles", "component_id", "kept", "first_row")


def missed(similarity: float, trees: int) -> float:
    """Chance that no tree brings a pair of that similarity together at ``MAX_DEPTH``.

    That is the worst case, of nodes that are large at every level. All trees draw
    from the same tokens, so the sum goes over how many of them the pair shares.
    Given that number, trees of different starting tokens meet no less often than
    independent ones do.
    """
    total = 0.0
    for shared in range(TOKENS + 1):
        weight = math.comb(TOKENS, shared)
        weight *= similarity**shared * (1 - similarity) ** (TOKENS - shared)
        start = math.comb(shared, START_DEPTH) / math.comb(TOKENS, START_DEPTH)
        lost = 0.0
        for _ in range(START_DEPTH, MAX_DEPTH):
            lost = (1 - shared / TOKENS * (1 - lost)) ** 2
        total += weight * (1 - start * (1 - lost)) ** trees
    return total


def trees_needed(similarity: float, recall: float = RECALL) -> int:
    """Trees until a pair of that similarity is missed with a chance of 1 - recall at most."""
    trees = math.ceil(math.log(1 - recall) / math.log(1 - similarity**START_DEPTH))
    while missed(similarity, trees) > 1 - recall:
        trees += 1
    return trees


def minwise_tokens(shingles: np.ndarray) -> bytes:
    least = np.full(TOKENS, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[None, i : i + 2048] * _MULTIPLY[:, None] + _ADD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def _set_of(text: str | None, shingle: int) -> np.ndarray:
    return shingle_set(utf8(text).translate(LOWER_ASCII), shingle)


def sketch(text: Column, shingle: int) -> Column:
    """Set size, a 128-bit key of the set, and its minwise tokens."""

    @F.pandas_udf("n long, set_key binary, tokens binary")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = _set_of(text, shingle)
                key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                rows.append((len(found), key, minwise_tokens(found) if len(found) else b""))
            yield pd.DataFrame(rows, columns=["n", "set_key", "tokens"])

    return sketched(text)


def _token_matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u4").reshape(-1, TOKENS).astype(np.uint64)


def _child(node: np.ndarray, coordinate, token: np.ndarray) -> np.ndarray:
    step = mixed(token + (np.asarray(coordinate).astype(np.uint64) << np.uint64(32)))
    return mixed(node * np.uint64(0x9E3779B97F4A7C15) ^ step)


def starting_nodes(classes: DataFrame, trees: int) -> DataFrame:
    """(node, cls, n, load): the node of each class at the starting depth, per tree."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        choice = np.random.default_rng(31)
        chosen = np.concatenate(
            [choice.permutation(TOKENS) for _ in range(1 + trees * START_DEPTH // TOKENS)]
        )[: trees * START_DEPTH].reshape(trees, START_DEPTH)
        for batch in batches:
            tokens = _token_matrix(batch["tokens"])
            for tree in range(trees):
                node = mixed(np.full(len(batch), tree + 1, dtype=np.uint64))
                for coordinate in chosen[tree]:
                    node = _child(node, coordinate, tokens[:, coordinate])
                yield pd.DataFrame(
                    {
                        "node": node.view(np.int64),
                        **{name: batch[name] for name in ("cls", "n", "load")},
                    }
                )

    return classes.select("cls", "n", "load", "tokens").mapInPandas(
        walk, "node long, cls long, n long, load long"
    )


def child_nodes(members: DataFrame) -> DataFrame:
    """One level down: each member's children, by the tokens its node chooses."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            tokens = _token_matrix(batch["tokens"])
            node = batch["node"].to_numpy().view(np.uint64)
            for chooser in (1, 3):
                pick = mixed(node + np.uint64(chooser)) % np.uint64(TOKENS)
                # Parents apart: one class may come to a node on two ways.
                token = tokens[np.arange(len(batch)), pick]
                child = _child(node + np.uint64(chooser), pick, token)
                yield pd.DataFrame(
                    {
                        "node": child.view(np.int64),
                        **{name: batch[name] for name in ("cls", "load", "comp")},
                    }
                )

    return members.select("node", "cls", "load", "comp", "tokens").mapInPandas(
        walk, "node long, cls long, load long, comp long"
    )


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    """The sizes alone don't rule the pair out."""
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) of classes whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            verdicts, last, last_set = [], None, None
            for a, b in zip(left, right, strict=True):
                if a is not last:
                    last, last_set = a, _set_of(a, shingle)
                other = _set_of(b, shingle)
                common = len(np.intersect1d(last_set, other, assume_unique=True))
                verdicts.append(
                    100 * common >= percent * (len(last_set) + len(other) - common)
                )
            yield pd.Series(verdicts, dtype=bool)

    left = texts.select(F.col("cls").alias("u"), F.col("text").alias("u_text"))
    right = texts.select(F.col("cls").alias("v"), F.col("text").alias("v_text"))
    return (
        pairs.join(left, "u").join(right, "v").where(linked("u_text", "v_text")).select("u", "v")
    )


def joined_parts(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the place of the first one it is linked with, over others too.

    Intersections are exact counts, by products of 0/1 matrices over the shingles
    that occur in two sets or more, some thousand of them at a time.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    owner, column = owner[shared[place]], column[place][shared[place]]
    common = np.zeros((n, n))
    for start in range(0, int(shared.sum()), 4096):
        here = (column >= start) & (column < start + 4096)
        part = np.zeros((n, 4096), dtype=np.float32)
        part[owner[here], column[here] - start] = 1
        common += part @ part.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(linked, True)
    first = np.full(n, -1)
    for i in range(n):
        if first[i] < 0:
            reached = linked[i]
            while True:
                more = linked[reached].any(axis=0)
                if (more == reached).all():
                    break
                reached = more
            first[reached] = i
    return first


def links_within(
    members: DataFrame, texts: DataFrame, key: list[str], shingle: int, percent: int
) -> DataFrame:
    """Links (u, v) between the members of each node (or pair of blocks), found by
    comparing all of them; as few as hold the linked ones together.

    Where members carry ``comp``, the component they are known to be in, only links
    between components are returned, from one component's id to another's.
    """
    known = "comp" if "comp" in members.columns else "cls"

    def compare(node: pd.DataFrame) -> pd.DataFrame:
        node = node.drop_duplicates("cls").sort_values("cls")
        first = joined_parts([_set_of(text, shingle) for text in node["text"]], percent)
        met = node["known"].to_numpy()
        links = pd.DataFrame({"u": met[first], "v": met})
        return links[links["u"] != links["v"]].drop_duplicates()

    met = members.select(*key, "cls", F.col(known).alias("known")).join(texts, "cls")
    return met.groupBy(*key).applyInPandas(compare, "u long, v long")


def _small() -> str:
    """Condition on a node's ``size`` and ``mass`` (the load of its members)."""
    return f"(size <= {LEAF} and mass <= {LEAF_LOAD})"


def _blocks() -> str:
    """Number of blocks of a large node: two of them are no more than a small node."""
    return f"cast(ceil(2 * greatest(size / {LEAF}, mass / {LEAF_LOAD})) as int)"


def _nodes(members: DataFrame, **more: Column) -> DataFrame:
    """Size and mass of each node of two members or more, with ``more`` aggregates.

    Of nodes with the same members that are compared exhaustively one is left:
    comparing it finds all that the others would.
    """
    nodes = members.groupBy("node").agg(
        F.count("*").alias("size"),
        F.sum("load").alias("mass"),
        F.expr("bit_xor(xxhash64(cls))").alias("x"),
        F.expr("bit_xor(xxhash64(cls, 1L))").alias("y"),
        *(column.alias(name) for name, column in more.items()),
    )
    return (
        nodes.where("size > 1")
        .groupBy("size", "x", "y", F.expr(f"if({_blocks()} <= {max(2, BLOCKS)}, null, node)").alias("large"))
        .agg(*(F.min(name).alias(name) for name in ("node", "mass", *more)))
        .drop("x", "y", "large")
    )


def _open_nodes(members: DataFrame) -> DataFrame:
    """Members, with size and mass, of the nodes that hold two components or more."""
    nodes = _nodes(members, lo=F.min("comp"), hi=F.max("comp")).where("lo <> hi")
    return members.join(nodes.select("node", "size", "mass"), "node")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members of large nodes, once for each pair of different blocks that their own
    is in; pairs within a block meet in each of these."""
    placed = members.withColumn("blocks", F.expr(_blocks())).withColumn(
        "own", F.expr("cast(pmod(xxhash64(cls), blocks) as int)")
    )
    others = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return others.where("other <> own").select(
        "*", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``docs`` with the size of each shingle set and the id of each component.

    Two documents are linked where 100 * intersection >= ``percent`` * union of
    their sets of ``shingle``-word windows (A-Z lower-cased). ``kept`` marks the
    documents whose id is the component's; ``first_row`` marks exactly one row
    of each component, also where ids repeat or are null.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*docs.columns).alias("doc"),
        sketch(F.col(text_col), shingle).alias("s"),
    )
    base, _ = scratch.write(rows, "sketches")
    own_id = F.col("doc").getField(id_col)
    # The first row by id, nulls last; what follows the row only rides along.
    member = F.struct(
        own_id.isNull().alias("no_id"),
        own_id.alias("id"),
        "row",
        F.col("s.n").alias("n"),
        F.greatest("s.n", F.octet_length(F.col("doc").getField(text_col)) / 8)
        .cast("long")
        .alias("load"),
        F.col("s.tokens").alias("tokens"),
    )
    classes, _ = scratch.write(
        base.where("s.n > 0")
        .groupBy(F.col("s.set_key").alias("set_key"))
        .agg(F.min(member).alias("first"))
        .select("set_key", "first.*")
        .withColumn("cls", F.col("row")),
        "classes",
    )
    nodes, nodes_path = scratch.write(
        starting_nodes(classes, trees_needed(percent / 100)), "nodes"
    )
    groups = _nodes(nodes, lead=F.min(F.struct("cls", "n")))
    shared, shared_path = scratch.write(nodes.join(groups, "node"), "shared-nodes")
    scratch.drop(nodes_path)
    texts, texts_path = scratch.write(
        base.select(F.col("row").alias("cls"), F.col("doc").getField(text_col).alias("text")).join(
            # One plan at every size; on large tables Spark adds a Bloom filter of its own.
            shared.select("cls").distinct().hint("merge"),
            "cls",
        ),
        "candidates",
    )
    # Of a node of two the star is all there is.
    star = (
        shared.where(f"size = 2 or not {_small()}")
        .where("cls <> lead.cls")
        .where(_sizes_fit("n", "lead.n", percent))
        .select(F.col("lead.cls").alias("u"), F.col("cls").alias("v"))
        .distinct()
    )
    small = shared.where(f"size > 2 and {_small()}")
    found = confirmed(star, texts, shingle, percent).unionByName(
        links_within(small, texts, ["node"], shingle, percent)
    )
    links, _ = scratch.write(found, "links")
    labels = components(links, scratch)

    members = shared.where(f"size > 2 and not {_small()}").select("node", "cls", "load")
    known = labels.select(F.col("u").alias("cls"), F.col("v").alias("comp"))
    members = members.join(known, "cls", "left").select(
        "node", "cls", "load", F.coalesce("comp", "cls").alias("comp")
    )
    more = []
    for depth in range(START_DEPTH, MAX_DEPTH + 1):
        live, _ = scratch.write(_open_nodes(members), "open-nodes")
        if live.isEmpty():
            break
        if depth > START_DEPTH:
            more.append(
                links_within(live.where(_small()), texts, ["node"], shingle, percent)
            )
        large = live.where(f"not {_small()}")
        at_once = large if depth == MAX_DEPTH else large.where(f"{_blocks()} <= {BLOCKS}")
        blocks = ["node", "lo", "hi"]
        more.append(links_within(_in_blocks(at_once), texts, blocks, shingle, percent))
        if depth < MAX_DEPTH:
            branching = large.where(f"{_blocks()} > {BLOCKS}")
            children = child_nodes(branching.join(classes.select("cls", "tokens"), "cls"))
            members, _ = scratch.write(children, "children")
    if more:
        for part in more:
            links = links.unionByName(part)
        labels = components(scratch.write(links, "all-links")[0], scratch)
    scratch.drop(texts_path)
    scratch.drop(shared_path)

    grouped = classes.join(labels.withColumnRenamed("u", "cls"), "cls", "left").select(
        "set_key", F.coalesce("v", "cls").alias("comp"), F.struct("no_id", "id", "row").alias("first")
    )
    heads = grouped.groupBy("comp").agg(F.min("first").alias("head"))
    known, _ = scratch.write(grouped.join(heads, "comp").select("set_key", "head"), "components")
    own = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in RESULT_COLUMNS]
    empty = F.col("s.n") == 0
    component = F.when(empty, own_id).otherwise(F.col("head.id"))
    return base.join(known, F.col("s.set_key") == F.col("set_key"), "left").select(
        *own,
        F.col("s.n").alias("n_shingles"),
        component.alias("component_id"),
        own_id.eqNullSafe(component).alias("kept"),
        (empty | (F.col("row") == F.col("head.row"))).alias("first_row"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    clash = [c for c in docs.columns if c in RESULT_COLUMNS]
    free = docs.withColumnsRenamed({c: f"doc {c}" for c in clash})
    kept = near_duplicates(free, **options).where("first_row").drop(*RESULT_COLUMNS)
    return kept.withColumnsRenamed({f"doc {c}": c for c in clash}).select(docs.columns)
