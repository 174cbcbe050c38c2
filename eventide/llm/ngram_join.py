"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its word n-gram hashes. Two documents link when their
sets' Jaccard similarity reaches ``percent``; the result names each document's
connected component.

*Prefixes.* Order every set by hash. If two sets of sizes a and b overlap in at
least ``need = ceil(percent * size)`` elements, then their first ``size - need +
m`` elements share at least m. So a prefix can be lengthened by m - 1 elements
and in turn must share m of them. The first pass ships short prefixes
(``LEVELS[0]`` of the set's size as m). With exact document frequencies of the
prefix elements, a document whose prefix holds fewer than m elements that any
other document has can have no partner and is finished, without any pair. Of
the others' common elements all but the m - 1 most frequent are kept: two
partners still share a kept one. The frequencies give a document's candidate
cost; where it is over ``MAX_COST`` the prefix is lengthened to the next level,
which demands correspondingly more shared elements, up to the whole set. Pairs
are looked for on the lower of the two documents' levels.

*Verification without pairs of a group.* Equal sets are one class from the
start. Classes that keep the same element form a bucket; an element kept once is done. In each star round
every bucket checks one member per component against one centre (linear work)
and verified links merge components. What is left then, members of different
components in a bucket, is checked pair by pair, so no link between components
is lost, while the pairs inside a component are never formed. A pair is looked
at only where the shared element's places in both prefixes leave room for the
overlap; members for which no size in the bucket leaves room drop out first.

Sets to verify are written once, bucketed by class, and read in place. Shuffles
carry prefix elements (about a fifth of the n-grams, 16 bytes each), the texts
of documents with candidates, and the sets of star members.

Defined cases: a text with fewer words than the n-gram size is its word
sequence as one element; without words the set is empty and links with
nothing, the component is the document itself; a null id takes no part in
links and gets a null component; repeated rows are one class, equal ids with
different texts are different documents whose components carry their smallest
id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import wordbytes as wb
from .common import bucketed, buckets_for, drop_written, release, written

LEVELS = (0.05, 0.3, 1.0)    # shared prefix elements demanded, as a share of the set
MAX_COST = 64                # candidates (with repeats) a document's prefix may meet
STAR_ROUNDS = 3
BITMAP = 1 << 23             # bits of the fixed-size filter on document ids
SET_BUCKET_BYTES = 16 << 20

_KINDS = 1 - wb.separators(wb.WHITE).astype(np.uint8)


# ---- prefix arithmetic: numpy arrays, ints and Columns alike ------------------

def need(n, percent: int):
    """Smallest overlap of a linked pair with a set of n elements in it."""
    return (percent * n + 99) // 100


def matches(n: int, percent: int, share: float) -> int:
    """Elements that a pair must share in prefixes of this level."""
    full = need(n, percent)
    return full if share >= 1 else min(full, 1 + int(share * n))


def prefix_length(n: int, percent: int, share: float) -> int:
    return n - need(n, percent) + matches(n, percent, share)


def _ceil_percent(n: Column, percent: int) -> Column:
    return F.floor((percent * n + 99) / 100).cast("long")


def _prefix_length(n: Column, percent: int, share: float) -> Column:
    if share >= 1:
        return n
    full = _ceil_percent(n, percent)
    return n - full + F.least(full, 1 + F.floor(share * n).cast("long"))


def demanded(n: Column, percent: int, share: float) -> Column:
    """``matches`` of the smallest partner of a set: what any partner must share."""
    least = _ceil_percent(n, percent)
    if share >= 1:
        return least
    return F.least(_ceil_percent(least, percent), 1 + F.floor(share * least).cast("long"))


# ---- sets ---------------------------------------------------------------------

def shingle_sets(column: pa.Array, size: int):
    """Sorted distinct n-gram hashes (int64) of each text, in order."""
    for _, text, offsets in wb.blocks(column):
        w = wb.words(text, offsets, _KINDS, wb.LOWER)
        at, gram = wb.windows(w, size)
        gram = gram.view(np.int64)
        first = np.searchsorted(at, w.first)
        for row in range(w.rows):
            count = w.first[row + 1] - w.first[row]
            if count >= size:
                yield np.unique(gram[first[row]:first[row + 1]])
            elif count:
                yield np.array([wb.whole(w, row)], np.uint64).view(np.int64)
            else:
                yield np.zeros(0, np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _print(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _prefixes(size: int, percent: int):
    """Every row's set size and print; the prefix at a task's first row of a print."""
    def run(batches):
        uid, seen, none = TaskContext.get().partitionId() << 33, set(), np.zeros(0, np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch.column(2), size))
            prints, prefixes = [_print(s) for s in sets], []
            for own, name, doc_id in zip(sets, prints, batch.column(0).to_pylist()):
                new = doc_id is not None and name not in seen
                prefixes.append(own[:prefix_length(len(own), percent, LEVELS[0])]
                                if new and len(own) else none)
                if new:
                    seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(range(uid, uid + len(sets)), pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(prints, pa.binary()), _lists(prefixes)],
                names=["doc_id", "text_md5", "uid", "n", "print", "prefix"])
            uid += len(sets)
    return run


def _whole_sets(size: int):
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_print(s) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), _lists(sets)],
                names=["doc_id", "print", "n", "elements"])
    return run


def _may_be_in(ids: DataFrame, col: str) -> Column:
    """Whether a row's id may be one of ids (column ``col`` in both): a bitmap of
    fixed size, broadcast; never false for an id that is there."""
    bit = F.pmod(F.xxhash64(F.col(col)), F.lit(BITMAP))
    rows = (ids.select(bit.alias("b"))
            .groupBy(F.floor(F.col("b") / 64).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits")).collect())
    words = np.zeros(BITMAP // 64, np.int64)            # BITMAP / 64 rows at most
    for r in rows:
        words[r["at"]] = r["bits"]
    held = ids.sparkSession.sparkContext.broadcast(words.view(np.uint8))

    def may(column: pa.Array) -> pa.Array:
        at = column.to_numpy(zero_copy_only=False)
        return pa.array(held.value[at >> 3] >> (at & 7) & 1 == 1, pa.bool_())

    return F.arrow_udf(may, "boolean")(bit)


# ---- levels ---------------------------------------------------------------------

def _kept(postings: DataFrame, percent: int, share: float,
          classes: DataFrame | None = None) -> DataFrame:
    """(cls, n, element, members, size, pos): elements by which partners on this level
    must meet; pos is the element's place in the prefix (of ``size`` elements)
    ordered by frequency, the rarest first; members counts the classes that keep
    the element (one alone has no partner there). With ``classes``, postings of
    other copies of a class only count into frequencies."""
    df = (postings.groupBy("element").agg(F.count("*").alias("df")).where(F.col("df") > 1))
    own = Window.partitionBy("cls")
    shared = postings.join(df, "element")
    if classes is not None:
        # one row per class; a semi join would be moved below the explode and
        # shuffle whole prefixes
        shared = shared.join(classes.select("cls"), "cls")
    common = (shared.withColumn("common", F.count("*").over(own))
              .where(F.col("common") >= demanded(F.col("n"), percent, share)))
    kept = (common.withColumn("rank", F.row_number().over(own.orderBy("df", "element")))
            .where(F.col("rank") <= F.col("common") - demanded(F.col("n"), percent, share) + 1)
            .select("cls", "n", "element",
                    _prefix_length(F.col("n"), percent, share).alias("size"),
                    (_prefix_length(F.col("n"), percent, share) - F.col("common")
                     + F.col("rank")).alias("pos")))
    kept = written(kept, "kept")
    met = kept.groupBy("element").agg(F.count("*").alias("members")).where("members > 1")
    return written(kept.join(met, "element"), "kept")


def _candidates(prefixes: DataFrame, classes: DataFrame, docs: DataFrame, size: int,
                percent: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Buckets (level, element, cls, n, size, pos, settled) of all levels; sets of
    their classes."""
    spark = docs.sparkSession
    postings = prefixes.select(F.col("uid").alias("cls"), "n", F.explode("prefix").alias("element"))
    kept = _kept(postings, percent, LEVELS[0], classes)
    drop_written(prefixes)
    release(spark)
    alive = classes.select("cls", "doc_id", "print").join(
        kept.select("cls").distinct(), "cls", "left_semi")
    alive = written(alive, "alive")
    texts = docs.where(_may_be_in(alive.select("doc_id"), "doc_id"))
    sets = (texts.mapInArrow(_whole_sets(size),
                             "doc_id long, print binary, n long, elements array<long>")
            .join(alive, ["doc_id", "print"]).repartition(buckets, "cls")
            .groupBy("cls").agg(F.first("n").alias("n"), F.first("elements").alias("elements")))
    sets = bucketed(sets, "cls", buckets, "sets")
    release(spark)

    found = []
    for level, share in enumerate(LEVELS):
        last = level == len(LEVELS) - 1
        cost = kept.groupBy("cls").agg(F.sum(F.col("members") - 1).alias("cost"))
        dear = (cost.where(F.col("cost") > MAX_COST).select("cls", F.lit(False).alias("settled"))
                if not last else cost.limit(0).select("cls", F.lit(False).alias("settled")))
        marked = kept.join(dear, "cls", "left").select(
            F.lit(level).alias("level"), "element", "cls", "n", "size", "pos",
            F.coalesce("settled", F.lit(True)).alias("settled"))
        found.append(marked)
        if last:
            break
        longer = LEVELS[level + 1]
        length = _prefix_length(F.col("n"), percent, longer)
        more = sets.join(dear.select("cls"), "cls", "left_semi").select(
            "cls", "n", F.explode(F.slice("elements", F.lit(1), length.cast("int")))
            .alias("element"))
        kept = _kept(more, percent, longer)
        release(spark)
    everything = found[0]
    for more in found[1:]:
        everything = everything.unionByName(more)
    # two members that both go on to the next level meet there
    key = ["level", "element"]
    live = (everything.groupBy(*key).agg(F.max("settled").alias("settled"),
                                         F.count("*").alias("members"))
            .where("settled and members > 1"))
    return written(everything.join(live, key, "left_semi"), "buckets"), sets


# ---- verification and components ------------------------------------------------

def _linked(percent: int):
    share = LEVELS[1]

    def same(a: pa.Array, b: pa.Array) -> pa.Array:
        ends = [x.offsets.to_numpy() for x in (a, b)]
        flat = [x.values.to_numpy() for x in (a, b)]
        out = np.zeros(len(a), bool)
        for k in range(len(a)):
            x, y = (f[e[k]:e[k + 1]] for f, e in zip(flat, ends))
            fewer = min(matches(len(v), percent, share) for v in (x, y))
            px, py = (v[:prefix_length(len(v), percent, share)] for v in (x, y))
            if len(np.intersect1d(px, py, assume_unique=True)) < fewer:
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            out[k] = 100 * both >= percent * (len(x) + len(y) - both)
        return pa.array(out, pa.bool_())

    return F.arrow_udf(same, "boolean")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, as (a, b)."""
    right = sets.select(F.col("cls").alias("b"), F.col("elements").alias("set_b"))
    left = sets.select(F.col("cls").alias("a"), F.col("elements").alias("set_a"))
    return (pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
            .where(_linked(percent)(F.col("set_a"), F.col("set_b"))).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root): roots are the smallest nodes; nodes without links are absent.

    Each round every node points to its smallest neighbour, pointers are doubled
    until they are flat, and links are lifted to the roots.
    """
    links = written(links.where("a <> b").distinct(), "links")
    result = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
                     .withColumnRenamed("a", "node"), "up")
        while True:
            parent = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            step = written(up.join(parent, "up").select(
                "node", F.col("next").alias("up"), (F.col("next") < F.col("up")).alias("moved")),
                "up")
            up = step.select("node", "up")
            if step.where("moved").isEmpty():
                break
        result = up if result is None else (
            result.join(up.select(F.col("node").alias("up"), F.col("up").alias("next")),
                        "up", "left")
            .select("node", F.coalesce("next", "up").alias("up"))
            .unionByName(up.join(result.select("node"), "node", "left_anti")))
        result = written(result, "roots")
        roots = up.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        links = written(
            links.join(roots, "a").join(roots.select(F.col("a").alias("b"),
                                                     F.col("ra").alias("rb")), "b")
            .where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "links")
    if result is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return result.withColumnRenamed("up", "root")


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (cls, comp) after linking classes a and b."""
    comp = comps.select(F.col("cls").alias("a"), F.col("comp").alias("ca"))
    lifted = (links.join(comp, "a").join(comp.select(F.col("a").alias("b"),
                                                     F.col("ca").alias("cb")), "b")
              .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    roots = components(lifted).select(F.col("node").alias("comp"), "root")
    return written(comps.join(roots, "comp", "left")
                   .select("cls", F.coalesce("root", "comp").alias("comp")), "comps")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether a shared element at its place can be the first one of a linked pair.

    The overlap must reach ``percent / (100 + percent)`` of both sizes together;
    what lies outside the shorter prefix may be shared too, and from the first
    shared element on, no more than the rest of either prefix can be.
    """
    na, nb, sa, sb, pa_, pb = (F.col(f"{x}.{c}") for c in ("n", "size", "pos") for x in (a, b))
    overlap = F.ceil(percent * (na + nb) / (100 + percent))
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & (1 + F.least(sa - pa_, sb - pb) >= overlap - F.greatest(na - sa, nb - sb)))


def _links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (cls, comp) of all classes that stand in a bucket."""
    comps = written(buckets.select("cls").distinct().select("cls", F.col("cls").alias("comp")),
                    "comps")
    key = ["level", "element"]
    for turn in range(STAR_ROUNDS):
        # the first centres are the members with the fewest rare elements, the
        # likeliest originals of a group; later ones are drawn by hash
        spot = F.col("pos") if turn == 0 else F.xxhash64(F.col("cls"), F.lit(turn))
        whole = F.struct(spot.alias("spot"), "cls", "n", "size", "pos")
        reps = (buckets.join(comps, "cls").groupBy(*key, "comp").agg(F.min(whole).alias("r"))
                .select(*key, "comp", "r.*"))
        centres = (reps.groupBy(*key).agg(F.min(F.struct(
            "spot", "cls", "n", "size", "pos")).alias("c"), F.count("*").alias("members"))
            .where("members > 1").select(*key, "c.*"))
        pairs = written(
            reps.alias("x").join(centres.alias("c"), key)
            .where((F.col("x.cls") != F.col("c.cls")) & _possible("x", "c", percent))
            .select(F.col("c.cls").alias("a"), F.col("x.cls").alias("b")).distinct(), "pairs")
        if pairs.isEmpty():
            break
        comps = _merged(comps, _verify(pairs, sets, percent))

    # the rest, exactly: members outside a bucket's largest component meet all
    # others, as far as some partner of another component is possible at all
    placed = buckets.join(comps, "cls")
    parts = placed.groupBy(*key, "comp").agg(F.count("*").alias("members"))
    split = (parts.groupBy(*key).agg(F.max(F.struct("members", "comp")).alias("m"),
                                     F.count("*").alias("parts"))
             .where("parts > 1").select(*key, F.col("m.comp").alias("main")))
    placed = written(placed.join(split, key), "split")
    shapes = placed.groupBy(*key, "n", "size").agg(     # one row per set size of a bucket
        F.min("pos").alias("pos"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.max("settled").alias("settled"))
    met = written(placed.alias("x").join(shapes.alias("y"), (
        (F.col("x.level") == F.col("y.level")) & (F.col("x.element") == F.col("y.element"))
        & ((F.col("y.low") != F.col("x.comp")) | (F.col("y.high") != F.col("x.comp")))
        & (F.col("x.settled") | F.col("y.settled")) & _possible("x", "y", percent)),
        "left_semi"), "met")
    pairs = written(
        met.where("comp <> main").alias("x").join(met.alias("y"), (
            (F.col("x.level") == F.col("y.level")) & (F.col("x.element") == F.col("y.element"))
            & (F.col("x.comp") != F.col("y.comp"))
            & (F.col("x.settled") | F.col("y.settled")) & _possible("x", "y", percent)))
        .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
        .distinct(), "pairs")
    if pairs.isEmpty():
        return comps
    return _merged(comps, _verify(pairs, sets, percent))


def similar_groups(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked
    doc_id), text_md5, first (whether the text is its component's first, by id)."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    buckets = buckets_for(docs, SET_BUCKET_BYTES)
    prefixes = written(
        text.select("doc_id", F.md5("text").alias("text_md5"), "text").mapInArrow(
            _prefixes(size, percent), "doc_id long, text_md5 string, uid long, n long, "
                                      "print binary, prefix array<long>"), "prefixes")
    members = written(prefixes.drop("uid", "prefix"), "members")
    classes = written(
        prefixes.where("n > 0 and doc_id is not null").groupBy("print").agg(
            F.min(F.struct("doc_id", "text_md5")).alias("first"), F.min("uid").alias("cls"))
        .select("print", "first", "first.doc_id", "cls"), "classes")
    found, sets = _candidates(prefixes, classes, text, size, percent, buckets)
    comps = _links(found, sets, percent)
    member = classes.select("print", "cls", "first").join(comps, "cls", "left").select(
        "print", "first", F.coalesce("comp", "cls").alias("comp"))
    firsts = member.groupBy("comp").agg(F.min("first").alias("first"))
    named = member.drop("first").join(firsts, "comp").select("print", "first")
    # one print may belong to a third of all rows: the class side is a row per print
    own = F.struct("doc_id", "text_md5")
    return (members.join(named, "print", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce("first.doc_id", "doc_id")).alias("component_id"),
                    "text_md5", F.coalesce(F.col("first") == own, F.lit(True)).alias("first")))


def one_per_group(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One document of each component (the smallest id, then text), with all columns.

    Documents without words stay; so do rows without an id. Equal rows are one.
    """
    key = ["eventide_id", "eventide_md5"]
    groups = written(
        similar_groups(docs, size, percent, id_col, text_col)
        .select(F.col("doc_id").alias(key[0]), F.col("text_md5").alias(key[1]), "first")
        .groupBy(*key).agg(F.min("first").alias("first"), F.count("*").alias("rows")), "groups")
    keyed = docs.withColumns({
        key[0]: F.col(id_col).cast("long"),
        key[1]: F.md5(F.coalesce(F.col(text_col), F.lit("")))})
    # only texts that may go, or stand there twice, are shuffled
    doubt = groups.where("eventide_id is not null and (not first or rows > 1)").select(key[0])
    unsure = F.col(key[0]).isNotNull() & _may_be_in(doubt, key[0])
    exact = (keyed.where(unsure).join(groups.where("first").select(*key), key, "left_semi")
             .dropDuplicates(key))
    return keyed.where(~unsure).unionByName(exact).drop(*key)
