"""Class-based bigram language model: exchange clustering, class transitions and word emissions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import ascii_words, crc_of, discard, stored, text_or_empty, word_codes, word_hashes

CLASSES = 32             # word classes found by exchange
END, NEW = CLASSES, CLASSES + 1     # the class of ends and that of unseen words
HEAD = 2048              # most frequent words, whose classes are exchanged in full
SWEEPS = 6
CHUNK_TOKENS = 2_000_000
RAW = 64                 # occurrences of a word in a chunk above which its contexts are summed before they leave it
SMOOTH = 0.1
END_HASH = np.uint64(0)  # stands for the end among word hashes

CHUNK = "kinds binary, counts binary, tokens binary, lengths binary, held binary, ids binary, no_id binary"


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents as chunks of word codes: the words of a chunk by hash, their training counts, and the codes in order."""
    def pack(rows: list, words: list[list[bytes]]) -> pd.DataFrame:
        codes, kinds = word_codes([w for doc in words for w in doc])
        # Frequent words get small codes, whose upper bytes are zero and compress.
        order = np.argsort(-np.bincount(codes, minlength=len(kinds)), kind="stable")
        rank = np.empty(len(kinds), dtype=np.int32)
        rank[order] = np.arange(len(kinds), dtype=np.int32)
        codes, kinds = rank[codes], kinds[order]
        lengths = np.array([len(doc) for doc in words], dtype=np.int64)
        held = np.array([r[1] for r in rows], dtype=bool)
        ends = np.cumsum(lengths)
        tokens = np.insert(codes.astype(np.int32) + 1, ends, 0)          # code 0 is the end, after each document
        trained = np.repeat(~held, lengths + 1)
        hashes = word_hashes(kinds)
        hashes = np.concatenate([[END_HASH], np.where(hashes == END_HASH, END_HASH + np.uint64(1), hashes)]).astype(np.uint64)
        counts = np.bincount(tokens[trained], minlength=len(hashes)).astype(np.int64)
        ids, no_id = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=bool)
        return pd.DataFrame([(hashes.tobytes(), counts.tobytes(), _planes(tokens, len(hashes)), (lengths + 1).tobytes(), held.tobytes(),
                              ids.tobytes(), no_id.tobytes())], columns=[c.split()[0] for c in CHUNK.split(", ")])

    rows, words, size = [], [], 0
    for frame in frames:
        for doc_id, held, no_id, text in zip(frame["doc_id"], frame["held"], frame["no_id"], frame["text"]):
            doc = ascii_words(text)
            rows.append((doc_id, held, no_id))
            words.append(doc)
            size += len(doc) + 1
            if size >= CHUNK_TOKENS:
                yield pack(rows, words)
                rows, words, size = [], [], 0
    if rows:
        yield pack(rows, words)


def _planes(tokens: np.ndarray, kinds: int) -> bytes:
    """Codes as planes of their bytes, lowest first, as many as the largest code needs."""
    many = max(1, -(-int(kinds - 1).bit_length() // 8))
    return np.ascontiguousarray(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T[:many]).tobytes()


def _tokens(planes: bytes, many: int) -> np.ndarray:
    out = np.zeros(many, dtype=np.int32)
    for k, plane in enumerate(np.frombuffer(planes, dtype=np.uint8).reshape(-1, many)):
        out |= plane.astype(np.int32) << (8 * k)
    return out


def _ints(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(data, dtype=kind)


def exchange(pairs: pd.DataFrame, words: int, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the head words by exchange: each word in turn moves where the class bigrams' mutual information is highest.

    ``pairs`` counts neighbours ``a``, ``b`` among the head words; word 0 is the end and
    ``words`` stands for all others. These two keep classes of their own. Words start
    dealt over the classes by frequency rank, and sweeps end when no word moves.
    """
    end, other = classes, classes + 1
    of = np.concatenate([[end], np.arange(words - 1) % classes, [other]])
    a, b, n = (pairs[c].to_numpy() for c in ("a", "b", "n"))
    table = np.zeros((classes + 2, classes + 2))
    np.add.at(table, (of[a], of[b]), n)
    own = np.zeros(words + 1)
    own[a[a == b]] = n[a == b]
    after = np.argsort(a, kind="stable")
    before = np.argsort(b, kind="stable")
    after_at, before_at = np.searchsorted(a[after], np.arange(words + 2)), np.searchsorted(b[before], np.arange(words + 2))

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-12))

    for _ in range(sweeps):
        moved = 0
        for w in range(1, words):
            right, left = np.zeros(classes + 2), np.zeros(classes + 2)
            for side, order, at, ends in ((right, after, after_at, b), (left, before, before_at, a)):
                rows = order[at[w]:at[w + 1]]
                rows = rows[ends[rows] != w]
                np.add.at(side, of[ends[rows]], n[rows])
            if not left.any() and not right.any():
                continue
            old = of[w]
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= own[w]
            # The word's neighbours count in their own classes' totals wherever it goes.
            rows_of, columns_of = table.sum(1) + left, table.sum(0) + right
            whole = f(table)
            gain = ((f(table + left[:, None]) - whole).sum(0) + (f(table + right[None, :]) - whole).sum(1))[:classes]
            k = np.arange(classes)
            both = table[k, k]
            gain += f(both + left[k] + right[k] + own[w]) - f(both + left[k]) - f(both + right[k]) + f(both)
            gain -= f(rows_of[k] + right.sum() + own[w]) - f(rows_of[k])
            gain -= f(columns_of[k] + left.sum() + own[w]) - f(columns_of[k])
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += right
            table[:, new] += left
            table[new, new] += own[w]
            of[w] = new
            moved += new != old
        if not moved:
            break
    return of


def _class_contexts(chunks: DataFrame, head: np.ndarray, of: np.ndarray, classes: int) -> DataFrame:
    """The class of every word outside the head: the one whose neighbours are likeliest to be the word's.

    A chunk gives, for each of its words, the classes of the words before and after it in
    training documents: as one code an occurrence for a rare word, as counts by code for others, so a frequent word is at
    most two counts a class from each chunk. They are brought together by word and added up as they stream past.
    """
    order = np.argsort(head)
    spark = chunks.sparkSession
    shared = spark.sparkContext.broadcast((head[order], of[order]))
    table = _summed(chunks.mapInPandas(_transitions(shared, classes), CELLS), (classes + 2) ** 2).reshape(classes + 2, classes + 2) + SMOOTH
    to_left = np.log(table[:, :classes] / table[:, :classes].sum(0)).T
    to_right = np.log(table[:classes] / table[:classes].sum(1, keepdims=True))
    weights = spark.sparkContext.broadcast(np.concatenate([to_left, to_right], axis=1))

    def contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                kinds, (tokens, trained) = _ints(row.kinds, np.uint64), _trained(row)
                cls = _known(kinds, *shared.value, classes)
                at = np.flatnonzero(trained & (cls[tokens] == classes + 1))
                if not len(at):
                    continue
                left = cls[tokens[np.maximum(at - 1, 0)]]
                left[at == 0] = classes                    # before the first document stands an end
                right = cls[tokens[at + 1]] + classes + 2
                order = np.argsort(tokens[at], kind="stable")
                words = tokens[at][order]
                codes = np.stack([left[order], right[order]], axis=1).astype(np.uint8)
                cuts = np.flatnonzero(np.diff(words, prepend=-1))
                ends = np.append(cuts[1:], len(words))
                few = ends - cuts <= RAW
                yield pd.DataFrame({"word": kinds[words[cuts[few]]].view(np.int64), "codes": [codes[a:b].tobytes() for a, b in zip(cuts[few], ends[few])],
                                    "counts": b""})
                sums = [np.unique(codes[a:b], return_counts=True) for a, b in zip(cuts[~few], ends[~few])]
                yield pd.DataFrame({"word": kinds[words[cuts[~few]]].view(np.int64), "codes": [c.tobytes() for c, _ in sums],
                                    "counts": [n.astype(np.int32).tobytes() for _, n in sums]})

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wide = 2 * (classes + 2)
        held_word, held = None, np.zeros(wide, dtype=np.int64)
        for frame in frames:
            words = frame["word"].to_numpy()
            cuts = np.flatnonzero(np.diff(words, prepend=words[0] ^ 1)) if len(words) else np.zeros(0, int)
            if not len(cuts):
                continue
            place = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(words))))
            lengths = frame["codes"].str.len().to_numpy()
            flat = np.frombuffer(b"".join(frame["codes"]), dtype=np.uint8)
            times = np.ones(len(flat))
            summed = frame["counts"].str.len().to_numpy() > 0
            times[np.repeat(summed, lengths)] = np.frombuffer(b"".join(frame["counts"]), dtype=np.int32)
            counts = np.bincount(np.repeat(place, lengths) * wide + flat, times, len(cuts) * wide).astype(np.int64).reshape(-1, wide)
            names = words[cuts]
            if held_word is not None:
                if names[0] == held_word:
                    counts[0] += held
                else:
                    names, counts = np.insert(names, 0, held_word), np.concatenate([held[None], counts])
            held_word, held = names[-1], counts[-1]
            if len(names) > 1:
                best = np.argmax(counts[:-1] @ weights.value.T, axis=1)
                yield pd.DataFrame({"word": names[:-1], "class": best.astype(np.int32)})
        if held_word is not None:
            yield pd.DataFrame({"word": [held_word], "class": np.array([np.argmax(weights.value @ held)], dtype=np.int32)})

    return (chunks.mapInPandas(contexts, "word long, codes binary, counts binary").repartition("word").sortWithinPartitions("word")
            .mapInPandas(choose, "word long, class int"))


def _trained(row) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order, and which of them belong to training documents."""
    lengths, held = _ints(row.lengths), _ints(row.held, bool)
    return _tokens(row.tokens, int(lengths.sum())), np.repeat(~held, lengths)


def _known(kinds: np.ndarray, head: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    """Classes of words in the head; all others get the class after the end's."""
    at = np.minimum(np.searchsorted(head, kinds), len(head) - 1)
    return np.where(head[at] == kinds, of[at], classes + 1).astype(np.int64)


def _pairs(tokens: np.ndarray, trained: np.ndarray, cls: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Class (or word) before and of each training token; an end stands before every document."""
    of = cls[tokens]
    last = np.concatenate([[end], of[:-1]])
    return last[trained], of[trained]


def _transitions(shared, classes: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((classes + 2) ** 2, dtype=np.int64)
        for frame in frames:
            for row in frame.itertuples():
                kinds, (tokens, trained) = _ints(row.kinds, np.uint64), _trained(row)
                a, b = _pairs(tokens, trained, _known(kinds, *shared.value, classes), classes)
                total += np.bincount(a * (classes + 2) + b, minlength=len(total))
        yield _cells(total)
    return run


CELLS = "cell int, n long"


def _cells(counts: np.ndarray) -> pd.DataFrame:
    at = np.flatnonzero(counts)
    return pd.DataFrame({"cell": at.astype(np.int32), "n": counts[at]})


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    """Counts by cell over all tasks: as many rows at most as the model has cells."""
    out = np.zeros(size)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row.cell] = row.n
    return out


SUMS = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emitted double, "
        "steps binary, step_counts binary")


def class_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, head_words: int = HEAD, sweeps: int = SWEEPS) -> DataFrame:
    """Per document: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``.

    Words are the word rule's, A-Z in lower case; an end follows each document. All
    documents whose crc32 of the id mod 10 is not 0 are learned from, whole.

    Words are counted over the corpus. The ``head_words`` most frequent ones are put into
    classes by exchange on their neighbour counts, in ``sweeps`` sweeps at most; every other word then takes the class
    that fits its own neighbours best, so all words have a class. The probability of a
    word is that of its class after the class before, times the word's within its class.
    What training leaves to unseen words after a class is the share of words seen once
    there; both shares and counts are smoothed by 0.1, and the probabilities of all
    known words and the one unknown sum to 1.

    Null and empty texts are one end. A null id counts as the empty text. Repeated rows
    count as documents of their own. Without training documents each score is the base's.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    chunks = stored(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"), F.col(id_col).isNull().alias("no_id"),
                                (crc_of(id_col) % 10 == 0).alias("held"), text_or_empty(text_col).alias("text"))
                    .mapInPandas(_packed, CHUNK)
                    .withColumn("chunk", F.monotonically_increasing_id()))

    def kinds_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                kinds = _ints(row.kinds, np.uint64)
                yield pd.DataFrame({"chunk": row.chunk, "place": np.arange(len(kinds), dtype=np.int32), "word": kinds.view(np.int64),
                                    "n": _ints(row.counts)})

    places = chunks.select("chunk", "kinds", "counts").mapInPandas(kinds_of, "chunk long, place int, word long, n long")
    vocabulary = stored(places.filter("n > 0").groupBy("word").agg(F.sum("n").alias("n")))
    head_rows = vocabulary.filter(F.col("word") != 0).orderBy(F.col("n").desc(), "word").limit(head_words).collect()
    head = np.array([0] + [r.word for r in head_rows], dtype=np.int64).view(np.uint64)
    totals = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    train_tokens, kinds = totals.n or 0, totals.v

    ranked = np.argsort(head)
    shared = spark.sparkContext.broadcast((head[ranked], ranked.astype(np.int64)))
    words = len(head)

    def head_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                hashes, (tokens, trained) = _ints(row.kinds, np.uint64), _trained(row)
                sorted_head, place = shared.value
                at = np.minimum(np.searchsorted(sorted_head, hashes), words - 1)
                a, b = _pairs(tokens, trained, np.where(sorted_head[at] == hashes, place[at], words), 0)
                pair, n = np.unique(a * (words + 1) + b, return_counts=True)
                yield pd.DataFrame({"pair": pair, "n": n})

    def clustered(pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values("pair")
        split = pd.DataFrame({"a": pairs["pair"] // (words + 1), "b": pairs["pair"] % (words + 1), "n": pairs["n"]})
        return pd.DataFrame({"place": np.arange(words), "class": exchange(split, words, CLASSES, sweeps)[:words]})

    # One task gets at most (head_words + 2) ** 2 counts, however large the corpus is.
    found = (chunks.select("kinds", "tokens", "lengths", "held").mapInPandas(head_pairs, "pair long, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")).withColumn("_all", F.lit(0))
             .groupBy("_all").applyInPandas(clustered, "place int, class int").collect())
    of = np.full(words, END)
    for row in found:
        of[row.place] = row["class"]

    tail = _class_contexts(chunks.select("kinds", "tokens", "lengths", "held"), head, of, CLASSES)
    fixed = spark.createDataFrame([(int(w), int(c)) for w, c in zip(head.view(np.int64), of)], "word long, class int")
    classed = stored(vocabulary.join(fixed.unionByName(tail), "word", "left").select("word", "n", F.coalesce("class", F.lit(0)).alias("class")))
    by_class = {r["class"]: (r.n, r.v) for r in classed.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}

    wide = CLASSES + 2

    # Every chunk gets the counts and classes of its own words back: the vocabulary never has to fit one task.
    slices = (places.select("chunk", "place", "word").join(classed.filter(F.col("word").isNotNull()), "word", "left")
              .select("chunk", F.coalesce("n", F.lit(0)).alias("n"), (F.col("place").cast("long") * wide + F.coalesce("class", F.lit(NEW))).alias("slot")))

    def document_sums(key, chunk: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.itertuples():
            n, cls = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
            place = own["slot"] // wide
            n[place], cls[place] = own["n"], own["slot"] % wide
            sizes = np.array([by_class.get(c, (0, 0)) for c in range(wide)], dtype=float)
            emit = np.where(n > 0, np.log10((n + SMOOTH) / np.maximum(sizes[cls, 0] + SMOOTH * sizes[cls, 1], SMOOTH)), 0.0)
            base = np.log10((n + SMOOTH) / (train_tokens + SMOOTH * (kinds + 1)))
            tokens, trained = _trained(row)
            lengths, starts = _ints(row.lengths), np.cumsum(_ints(row.lengths)) - _ints(row.lengths)
            last = np.concatenate([[END], cls[tokens][:-1]])
            codes = last * wide + cls[tokens]
            owner = np.repeat(np.arange(len(lengths)), lengths)
            steps, step_counts = np.unique(owner * (wide * wide) + codes, return_counts=True)
            cuts = np.searchsorted(steps // (wide * wide), np.arange(len(lengths) + 1))
            once = np.bincount(last[trained & (n[tokens] == 1)], minlength=wide)
            frame = pd.DataFrame({"doc_id": pd.array(_ints(row.ids), dtype="Int64"), "held_out": _ints(row.held, bool), "n_tokens": lengths,
                                  "n_known": np.add.reduceat((n[tokens] > 0).astype(np.int64), starts),
                                  "base_score": np.add.reduceat(base[tokens], starts), "emitted": np.add.reduceat(emit[tokens], starts),
                                  "steps": [(steps[a:b] % (wide * wide)).astype(np.int16).tobytes() for a, b in zip(cuts, cuts[1:])],
                                  "step_counts": [step_counts[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])]})
            frame.loc[_ints(row.no_id, bool), "doc_id"] = pd.NA
            # A row for the chunk itself: its training class pairs, and by class how often a word seen once follows.
            seen = np.concatenate([np.bincount(codes[trained], minlength=wide * wide), once]).astype(np.int64)
            table = pd.DataFrame({"doc_id": pd.array([0], dtype="Int64"), "held_out": [False], "n_tokens": [-1], "n_known": [0],
                                  "base_score": [0.0], "emitted": [0.0], "steps": [seen.tobytes()], "step_counts": [b""]})
            out += [frame, table]
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in SUMS.split(", ")])

    sums = stored(chunks.select("chunk", "tokens", "lengths", "held", "ids", "no_id").groupBy("chunk").cogroup(slices.groupBy("chunk"))
                  .applyInPandas(document_sums, SUMS))

    def chunk_tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(wide * wide + wide, dtype=np.int64)
        for frame in frames:
            for cells in frame["steps"]:
                total += _ints(cells)
        yield _cells(total)

    cells = _summed(sums.filter("n_tokens = -1").select("steps").mapInPandas(chunk_tables, CELLS), wide * wide + wide)
    table, once = cells[:wide * wide].reshape(wide, wide), cells[wide * wide:]
    seen = table.sum(1)
    unseen = (once + SMOOTH) / (seen + once + 2 * SMOOTH)            # share left to the unknown word after each class
    present = np.array([by_class.get(c, (0, 0))[0] > 0 for c in range(wide)])
    smooth = np.where(present, table + SMOOTH, 0.0)
    step = np.full((wide, wide), -99.0)
    if train_tokens:
        step[:, present] = np.log10(smooth[:, present] / smooth.sum(1, keepdims=True) * (1 - unseen)[:, None])
        step[:, NEW] = np.log10(unseen)
    log_step = step.ravel()
    learned = bool(train_tokens)

    @F.pandas_udf("double")
    def stepped(steps: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([float(log_step[_ints(s, np.int16)] @ _ints(c, np.int32)) for s, c in zip(steps, counts)], dtype=float)

    discard(chunks, vocabulary, classed)
    score = F.col("emitted") + stepped("steps", "step_counts") if learned else F.col("base_score")
    return (sums.filter("n_tokens >= 0")
            .select(F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
                    "base_score", score.alias("score"))
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))
