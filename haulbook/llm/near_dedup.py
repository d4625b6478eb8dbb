"""MinHash near-dedup with BagMinHash signatures of shingle bags."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from haulbook.llm.common import ascii_words, batched, discard, giving_back, mixed, shingle_hashes, stored, text_or_empty, word_codes, word_hashes

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 30, 6      # at J = 0.8 the chance that no band meets is (1 - 0.8 ** 6) ** 30 = 1e-4
FIRST_BANDS = 2          # bands whose buckets try each member with one hub before any class is known
FILTER_BITS = 1 << 24    # bits of the filter that spares texts without a possible partner a shuffle
MAP_WORDS = 16           # 64-bit words of a node's map, in which each of its shingles sets one bit
AGREE = 140              # least equal bits of two 180-bit sketches; at J = 0.8 fewer come by a chance of 1e-7


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Text, shingle and count of each distinct shingle of each text, and a key of each text's words."""
    words = [ascii_words(t) for t in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    codes, kinds = word_codes([w for doc in words for w in doc])
    hashes, owner = shingle_hashes(word_hashes(kinds)[codes], lengths, SHINGLE)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    return owner[at], hashes[at], counts, [hashlib.sha256(b" ".join(w)).digest()[:16] for w in words]


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(owner: np.ndarray, shingles: np.ndarray, counts: np.ndarray, texts: int, size: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures: two bags agree in a place with the chance of their weighted Jaccard similarity.

    Weights are discretised at powers of two. Each shingle has a Poisson process over
    each weight level up to its count: points in time, each with a weight inside the
    level and a place of the signature. A bag owns the points whose weight its count
    covers, and a place keeps its earliest point. Points come in order of time, so a
    process ends once its time passes the latest place of its bag; levels of large
    weight come fast and fill the places early. Empty bags have infinite places.
    """
    least = np.full((texts, size), np.inf)
    flat = least.ravel()
    level = 0
    while len(owner):
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        live = counts > low
        owner, shingles, counts = owner[live], shingles[live], counts[live]
        own, weight = owner, counts
        seed = mixed(shingles, 1000 + level)
        time, k = np.zeros(len(own)), 0
        while len(own):
            draw = mixed(seed, 3 * k)
            time = time - np.log(_unit(draw)) / (high - low)
            ahead = time < least.max(axis=1)[own]
            own, weight, seed, time, draw = own[ahead], weight[ahead], seed[ahead], time[ahead], draw[ahead]
            inside = low + _unit(mixed(seed, 3 * k + 1)) * (high - low) < weight
            place = (mixed(seed, 3 * k + 2) % np.uint64(size)).astype(np.int64)
            np.minimum.at(flat, own[inside] * size + place[inside], time[inside])
            k += 1
        level += 1
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key a band."""
    bits = least.view(np.uint64).reshape(len(least), BANDS, ROWS)
    key = np.zeros(bits.shape[:2], dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key ^ bits[:, :, r], r)
    return mixed(key ^ np.arange(BANDS, dtype=np.uint64)[None, :], 99).view(np.int64)


def sketches(least: np.ndarray) -> np.ndarray:
    """One bit a place, in 64-bit words: two bags agree in a bit with chance (1 + J) / 2."""
    bits = (mixed(least.view(np.uint64), 55) >> np.uint64(63)).astype(np.uint8)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1).view(np.int64)


@giving_back
def _signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in batched(frames, "text", 3_000_000):
        owner, shingles, counts, keys = bags(part["text"].tolist())
        least = signatures(owner, shingles, counts, len(part))
        sizes = np.bincount(owner, counts, len(part)).astype(np.int64)
        sketch = sketches(least)
        yield pd.DataFrame({"_row": part["_row"], "_id": part["_id"], "_key": keys, "_size": sizes, "_s0": sketch[:, 0], "_s1": sketch[:, 1], "_s2": sketch[:, 2],
                            "_bands": list(band_keys(least))})


@giving_back
def _bagged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bags as sets: the n-th copy of a shingle is an element of its own, so set overlap is multiset overlap."""
    for part in batched(frames, "text", 3_000_000):
        owner, shingles, counts, keys = bags(part["text"].tolist())
        copy = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            items = mixed(np.repeat(shingles, counts) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 7).view(np.int64)
        cuts = np.cumsum(np.bincount(owner, counts, len(part)).astype(np.int64))[:-1]
        place = items.view(np.uint64) % np.uint64(64 * MAP_WORDS)
        maps = np.zeros(len(part) * MAP_WORDS, dtype=np.uint64)
        at = np.repeat(owner, counts) * MAP_WORDS + (place >> np.uint64(6)).astype(np.int64)
        np.bitwise_or.at(maps, at, np.uint64(1) << (place & np.uint64(63)))
        yield pd.DataFrame({"_node": part["_row"], "_bag": np.split(items, cuts), "_map": list(maps.view(np.int64).reshape(-1, MAP_WORDS))})


def rows_like(wanted: DataFrame, name: str) -> Column:
    """Whether a row number may be among the wanted ones: a bit filter of fixed size, right for all of them."""
    bit = F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))
    words = (wanted.select(bit.alias("b")).groupBy(F.expr("b div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits")))

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(1024, dtype=np.int64)
        held[rows["word"].to_numpy() % 1024] = rows["bits"]
        return pd.DataFrame({"block": [rows["word"].iloc[0] // 1024], "bits": [held.tobytes()]})

    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    blocks = words.withColumn("_b", F.expr("word div 1024")).groupBy("_b").applyInPandas(lambda f: block(f), "block long, bits binary")
    for r in blocks.collect():     # FILTER_BITS / 8 bytes at most
        table[r.block * 1024:(r.block + 1) * 1024] = np.frombuffer(r.bits, dtype=np.int64)
    shared = wanted.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def among(bits: pd.Series) -> pd.Series:
        b = bits.to_numpy()
        return pd.Series((shared.value[b // 64] >> (b % 64)) & 1 == 1)

    return among(bit)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs of nodes ``a``, ``b`` in classes ``ca``, ``cb``, the class links whose bags overlap to at least ``SIMILAR``."""
    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= SIMILAR * (len(x) + len(y) - both) - 1e-9)
        return pd.Series(out, dtype=bool)

    one, two = sets.select(F.col("_node").alias("a"), F.col("_bag").alias("_x")), sets.select(F.col("_node").alias("b"), F.col("_bag").alias("_y"))
    return (pairs.join(two, "b").join(one, "a").filter(alike("_x", "_y"))
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())


def may_link(a: Column, b: Column) -> Column:
    """Whether two nodes' numbers allow an overlap of ``SIMILAR``.

    Sizes bound it, and the shingles that other nodes hold as well; a bit that only one of the maps has stands for a
    shingle, at least, that only its node has. These bounds are exact. Sketches rule out most of what maps of long texts leave.
    """
    apart = lambda x, y: sum(F.bit_count(x["_map"][k].bitwiseAND(F.bitwise_not(y["_map"][k]))) for k in range(MAP_WORDS))
    fits = lambda both: both >= SIMILAR * (a["_size"] + b["_size"] - both) - 1e-9
    equal = F.lit(192) - sum(F.bit_count(a[s].bitwiseXOR(b[s])) for s in ("_s0", "_s1", "_s2"))
    return ((F.least(a["_size"], b["_size"]) >= SIMILAR * F.greatest(a["_size"], b["_size"])) & (equal >= AGREE + 12)
            & fits(F.least(a["_shared"], b["_shared"])) & fits(F.least(a["_size"] - apart(a, b), b["_size"] - apart(b, a))))


def components(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``_node`` and ``_class``, the smallest node that links lead to, by contraction of stored ``edges``, which are removed,
    and the stored tables that this reads.

    Each round every node joins its smallest neighbour and the edges move to what their
    ends have become, until none is left. Rounds shrink the graph at least by half.
    """
    steps = []
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy("a").agg(F.min("b").alias("_low")).select("a", F.least("a", "_low").alias("_to")))
        to_a, to_b = step.select("a", F.col("_to").alias("_a")), step.select(F.col("a").alias("b"), F.col("_to").alias("_b"))
        left = stored(edges.join(to_a, "a").join(to_b, "b").filter("_a <> _b")
                      .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
        discard(edges)
        edges = left
        steps.append(step)
    discard(edges)
    moves = steps[0].select(F.col("a").alias("_node"), F.col("_to").alias("_class"))
    for step in steps[1:]:
        moves = moves.join(step, moves["_class"] == step["a"], "left").select("_node", F.coalesce("_to", "_class").alias("_class"))
    return moves, steps


def _classes(source: DataFrame) -> DataFrame:
    """``_row``, ``_id``, ``_class`` (a row number of the class) per row of a stored ``source`` of ``_row``, ``_id`` and ``text``."""
    marked = stored(source.mapInPandas(_signed, "_row long, _id long, _key binary, _size long, _s0 long, _s1 long, _s2 long, _bands array<long>"))
    # The first row of a text stands for it; its number is the node.
    kinds = stored(marked.groupBy("_key").agg(F.min("_row").alias("_node")))
    nodes = (marked.filter("_size > 0").join(kinds.select(F.col("_node").alias("_row")), "_row", "left_semi")
             .select(F.col("_row").alias("_node"), "_size", "_s0", "_s1", "_s2", "_bands"))
    rows = nodes.select("_node", F.posexplode("_bands").alias("_band", "_bucket"))
    full = rows.groupBy("_bucket").agg(F.count("*").alias("_n")).filter("_n > 1").select("_bucket")
    near = stored(rows.join(full, "_bucket"))                       # ids alone: a node is in up to BANDS buckets
    wanted = stored(near.select("_node").distinct())
    first = wanted.select(F.col("_node").alias("_row"))
    # Most texts have no possible partner: a filter of fixed size keeps nearly all of them out of the shuffle. What it keeps is
    # stored, so that no task needs two Python workers at once, the filter's and that of the bags.
    likely = stored(source.select("_row", "text").filter(rows_like(first, "_row")))
    sets = stored(likely.join(first, "_row", "left_semi").mapInPandas(_bagged, "_node long, _bag array<long>, _map array<long>"))
    discard(likely)
    # Shingles that no other node holds bound a node's overlap with any partner. Those bounded below SIMILAR have none.
    alone = (sets.select("_node", F.explode("_bag").alias("_item")).groupBy("_item").agg(F.count("*").alias("_n"), F.min("_node").alias("_node"))
             .filter("_n = 1").groupBy("_node").agg(F.count("*").alias("_alone")))
    attrs = (nodes.drop("_bands").join(sets.select("_node", "_map"), "_node").join(alone, "_node", "left")
             .withColumn("_shared", F.col("_size") - F.coalesce("_alone", F.lit(0))).filter(F.col("_shared") >= SIMILAR * F.col("_size") - 1e-9))
    # The same order in every bucket: nodes with the fewest shingles of their own come first, as hubs for the others.
    one = F.struct((1 - F.col("_shared") / F.col("_size")).alias("_own"), F.xxhash64("_node").alias("_h"), "_node", "_size", "_shared", "_s0", "_s1", "_s2", "_map")
    attrs = stored(attrs.select("_node", one.alias("_one")))
    members = stored(near.join(attrs, "_node"))
    tried: list[DataFrame] = []

    def fresh(pairs: DataFrame) -> DataFrame:
        """Pairs ``a``, ``b`` of nodes in classes ``ca``, ``cb``, each once, without those that were tried before."""
        once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "ca", "cb").dropDuplicates(["a", "b"])
        for before in tried:
            once = once.join(before.select("a", "b"), ["a", "b"], "left_anti")
        tried.append(stored(once))
        return tried[-1]

    def merged(classes: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
        """The classes of all nodes after these links, and whether there were any."""
        links = stored(links)
        if links.isEmpty():
            discard(links)
            return classes, False
        parts, steps = components(links)
        step = parts.select(F.col("_node").alias("_class"), F.col("_class").alias("_new"))
        out = stored(classes.join(step, "_class", "left").select("_node", F.coalesce("_new", "_class").alias("_class")))
        discard(classes, *steps)
        return out, True

    def stars(rows: DataFrame) -> DataFrame:
        """Of rows (bucket, class, its first member ``_one``): the pair of each class with the hub of its bucket's largest class."""
        tops = rows.groupBy("_bucket").agg(F.max(F.struct("_n", (-F.col("_one._own")).alias("_c"), F.col("_one._node").alias("_i"), F.col("_class").alias("_top"),
                                                          F.col("_one").alias("_hub"))).alias("_t"))
        hub = tops.select("_bucket", "_t._top", "_t._hub")
        return (rows.join(hub, "_bucket").filter((F.col("_class") != F.col("_top")) & may_link(F.col("_one"), F.col("_hub")))
                .select(F.col("_hub._node").alias("a"), F.col("_one._node").alias("b"), F.col("_top").alias("ca"), F.col("_class").alias("cb")))

    # Each node starts as a class of its own. In the first bands every member is tried with one hub.
    classes = stored(attrs.select("_node", F.col("_node").alias("_class")))
    alike = members.filter(F.col("_band") < FIRST_BANDS).select("_bucket", F.col("_node").alias("_class"), "_one", F.lit(1).alias("_n"))
    classes, _ = merged(classes, verified(fresh(stars(alike)), sets))
    # Then one member of each class of a bucket with one of its largest class, until that links nothing more.
    more = True
    while more:
        held = members.join(classes, "_node").groupBy("_bucket", "_class").agg(F.count("*").alias("_n"), F.min("_one").alias("_one"))
        classes, more = merged(classes, verified(fresh(stars(held)), sets))
    # What is left: members outside their bucket's largest class, with all members of its other classes, each pair once.
    now = members.join(classes, "_node").select("_bucket", "_class", "_one")
    sizes = now.groupBy("_bucket", "_class").agg(F.count("*").alias("_n"))
    tops = (sizes.groupBy("_bucket").agg(F.max(F.struct("_n", "_class")).alias("_t"), F.count("*").alias("_many")).filter("_many > 1")
            .select("_bucket", F.col("_t._class").alias("_top")))
    now = stored(now.join(tops, "_bucket").withColumn("_main", F.col("_class") == F.col("_top")).drop("_top"))
    x, y = now.filter("not _main").alias("x"), now.alias("y")
    across = (F.col("x._class") != F.col("y._class")) & (F.col("y._main") | (F.col("x._class") < F.col("y._class")))
    pairs = (x.join(y, (F.col("x._bucket") == F.col("y._bucket")) & across & may_link(F.col("x._one"), F.col("y._one")))
             .select(F.col("x._one._node").alias("a"), F.col("y._one._node").alias("b"), F.col("x._class").alias("ca"), F.col("y._class").alias("cb")))
    classes, _ = merged(classes, verified(fresh(pairs), sets))
    labelled = stored(marked.select("_row", "_id", "_key").join(kinds, "_key").join(classes, "_node", "left")
                      .select("_row", "_id", F.coalesce("_class", "_node").alias("_class")))
    discard(marked, kinds, near, members, wanted, attrs, sets, now, classes, *tried)
    return labelled


def _source(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """Rows with a number that stays the same whenever they are read: stored once."""
    return stored(docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("text"), *others)
                  .withColumn("_row", F.monotonically_increasing_id()))


def _verdicts(labelled: DataFrame) -> DataFrame:
    """``_row``, ``_id``, ``class_id``, ``class_size`` and ``kept``, true on one row of each class: the first of the smallest id."""
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    sums = stored(labelled.groupBy("_class").agg(F.min(first).alias("_first"), F.count("*").alias("class_size")))
    return labelled.join(sums, "_class").select("_row", "_id", F.col("_first.id").alias("class_id"), "class_size", (F.col("_row") == F.col("_first.row")).alias("kept"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``class_id`` (the class's smallest id), ``class_size`` and ``kept`` (one row of each class, of the class id).

    Two texts are linked when the bags of their five-word shingles overlap to 0.8 or
    more (weighted Jaccard; words of the word rule, A-Z in lower case; a shorter text is
    one shingle). Classes are what links connect. Texts with the same words stand as one
    from the start, so copies are never compared. Texts without words form one class.

    Signatures in bands find candidates. In the first bands every member of a bucket is
    tried with one hub; then, in rounds over all bands, one member of each class of a bucket
    with one of its largest class, until a round links nothing; last, the members that are
    still outside their bucket's largest class with those of its other classes. Pairs inside a class need no trial,
    so nothing that would change a class is left out, and a group of near copies costs about one trial a
    member and round. A node's shingles that no other node holds bound its overlap with any partner; nodes bounded
    below 0.8 are settled at once, and nodes with the fewest such shingles are the hubs. Sizes, shared shingles and sketches
    rule out pairs inside the joins; every other pair is verified on the bags.

    The levels of a signature are independent processes at powers of two; no coarse process is split into finer ones.

    Null text counts as empty. Rows that share an id follow their texts; rows without an
    id count in their class but give it no id unless all lack one. An empty table gives
    no rows, further columns are ignored.
    """
    source = _source(docs, id_col, text_col)
    labelled = _classes(source)
    discard(source)
    return _verdicts(labelled).select(F.col("_id").alias(id_col), "class_id", "class_size", "kept")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with the columns it came with: the first of the class's smallest id; rows without an id come last.

    Rows are told apart by number, not by id, so a class is never lost to another that shares its id.
    """
    names = {f"c{i}": n for i, n in enumerate(docs.columns)}
    plain = docs.select(*[docs[n].alias(c) for c, n in names.items()], docs[id_col].alias("_doc"), docs[text_col].alias("_text"))
    numbered = _source(plain, "_doc", "_text", *names)
    gone = _verdicts(_classes(numbered.select("_row", "_id", "text"))).filter("not kept").select("_row")
    return numbered.join(gone, "_row", "left_anti").select(*[F.col(c).alias(n) for c, n in names.items()])
