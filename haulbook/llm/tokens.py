"""Byte-level BPE by prefix dynamic programming."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import batched, giving_back, text_or_empty

KEPT = 400_000    # runs that a task holds before the older ones go
PAIRS = 400_000   # tested pairs of tokens that a task holds
LONG = 64         # characters of the longest runs and pieces that are held


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: one token in base 64 and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class PrefixCoder:
    """BPE through one table per text: the last token of every byte prefix.

    The encoding of a prefix ends in exactly one token. A token that ends at byte i may
    be that one only if it and the last token of the prefix before it stay two tokens
    when their joined bytes are encoded alone; of all tokens ending at i just one does.
    Walking the table back from the end gives the encoding. The table of a text is a
    prefix of the table of any text that continues it, so bytes can be appended, and an
    edit needs new entries only from its place to where the old entries come back.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.length = {r: len(t) for t, r in ranks.items()}
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.edges: tuple[dict, dict] = {}, {}
        self.ends = ahocorasick.Automaton()
        for t, r in ranks.items():
            if self.stands(r) and len(t) > 1:
                self.ends.add_word(t.decode("latin-1"), (r, len(t)))
        self.ends.make_automaton()

    def stands(self, token: int) -> bool:
        """Whether the token's bytes are encoded as the token; keeps the two parts that its last merge joins."""
        data = self.bytes_of[token]
        parts, rank = [data[i:i + 1] for i in range(len(data))], self.ranks.get
        while len(parts) > 2:
            near = [rank(x + y, 1 << 60) for x, y in zip(parts, parts[1:])]
            best = min(near)
            if best == 1 << 60:
                return False
            at = near.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        self.halves[token] = (rank(parts[0]), rank(parts[1])) if len(parts) == 2 else None
        return True

    def edge(self, token: int, side: int) -> tuple[list[int], list[bytes]]:
        """The tokens that stood at one edge of the token, from its byte there to the token itself, and their bytes."""
        found = self.edges[side].get(token)
        if found is None:
            out = [token]
            while self.halves[out[-1]]:
                out.append(self.halves[out[-1]][side])
            out.reverse()
            found = self.edges[side][token] = out, [self.bytes_of[t] for t in out]
        return found

    def follows(self, before: int, token: int) -> bool:
        """Whether the two stay apart: no merge across them comes before the merges that build them.

        Of equal ranks the left merge comes first.
        """
        key = before << 32 | token
        found = self.pairs.get(key)
        if found is None:
            (left, left_bytes), (right, right_bytes), i, j, never = self.edge(before, 1), self.edge(token, 0), 0, 0, 1 << 60
            rank, found = self.ranks.get, True
            while found:
                left_ends = left[i + 1] if i + 1 < len(left) else never
                right_ends = right[j + 1] if j + 1 < len(right) else never
                across = rank(left_bytes[i] + right_bytes[j], never)
                if across < left_ends and across <= right_ends and across != never:
                    found = False
                elif left_ends == right_ends == never:
                    break
                elif left_ends <= right_ends:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Add the entries up to byte ``upto``. The automaton names the longer tokens that end at each byte, longest first.

        Since just one token may be the last, the byte's own token is where none of the longer may.
        """
        pair, done = self.pairs.get, len(last)
        base, settled = max(0, done + 1 - self.longest), done - 1
        own = list(map(self.single.__getitem__, data[done:upto]))
        if None in own:
            raise ValueError("the ranks do not cover every byte")
        last += own
        for end, (token, length) in self.ends.iter(data[base:upto].decode("latin-1")) if len(self.ends) else ():
            end += base
            if end > settled:
                start = end + 1 - length
                if start:
                    before = last[start - 1]
                    apart = pair(before << 32 | token)
                    if not apart and (apart is not None or not self.follows(before, token)):
                        continue
                last[end], settled = token, end

    def table(self, data: bytes, known: list[int] | None = None) -> list[int]:
        """Last token of each prefix of ``data``; ``known`` is the table of a text that ``data`` continues."""
        last = list(known or [])
        self.extend(data, last, len(data))
        return last

    def edited(self, old: bytes, last: list[int], at: int, gone: int, new: bytes) -> tuple[bytes, list[int]]:
        """Bytes and table after ``gone`` bytes at ``at`` became ``new``.

        Entries before the edit stay. After it, once as many entries in a row as the
        longest token has bytes equal the old ones, so do all later ones, since an entry
        depends on no more than that many bytes and entries before it.
        """
        data = old[:at] + new + old[at + gone:]
        out, shift, same = last[:at], len(new) - gone, 0
        while len(out) < len(data):
            done = len(out)
            self.extend(data, out, min(len(data), done + self.longest))
            for place in range(done, len(out)):
                same = same + 1 if place - shift >= at + gone and out[place] == last[place - shift] else 0
                if same >= self.longest:
                    return data, out[:place + 1] + last[place + 1 - shift:]
        return data, out

    def tokens(self, last: list[int]) -> list[int]:
        """The encoding that a table stands for."""
        out, end, length = [], len(last), self.length
        while end:
            token = last[end - 1]
            out.append(token)
            end -= length[token]
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        last: list[int] = []
        self.extend(data, last, len(data))
        return self.tokens(last)


class KnownRuns(dict):
    """Packed ids of runs and of their pieces; a piece is cut like a run of itself, so one table holds both.

    When full, those not asked for since it was last full are let go; long ones are never held.
    """

    def __init__(self, coder: PrefixCoder, pattern: str):
        self.coder, self.cut, self.older = coder, regex.compile(pattern).findall, {}

    def __missing__(self, run: str) -> bytes:
        out = self.older.get(run)
        if out is None:
            pieces = self.cut(run)
            out = array("i", self.coder.encode(run.encode())).tobytes() if pieces == [run] else b"".join(map(self.__getitem__, pieces))
        if len(run) <= LONG:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[run] = out
        return out


class TextCoder:
    """Encodes texts piece by piece. Words with the space before them repeat, so frequent ones are encoded once a task."""

    # A run of non-space with the space before it can be cut into pieces by itself; \x1c-\x1f are no spaces in the piece pattern.
    runs = re.compile(r" ?(?:\S|[\x1c-\x1f])+|(?:(?![\x1c-\x1f])\s)+(?!\S|[\x1c-\x1f])|(?:(?![\x1c-\x1f])\s)+")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # The tables refer to what they are made from, never back to this object: without cycles, a task's tables go with the task.
        coder = PrefixCoder(ranks)
        self.known = KnownRuns(coder, pattern)
        self.id_bytes = coder.bytes_of.__getitem__

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text."""
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.runs.findall(text))), dtype=np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.id_bytes, ids))


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Per document: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, and the ``ids`` themselves if wanted.

    Null text counts as empty: no tokens and the digests of nothing. Each row is encoded
    by itself, so repeated rows give repeated results; further columns are ignored. The
    rank file is read by the driver and broadcast: its size is that of the vocabulary.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    @giving_back
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = TextCoder(shared.value, pattern)
        decimal = {i: b"%d" % i for i in shared.value.values()}.__getitem__
        for part in batched(frames, "text", 4_000_000):
            counts, digests, decoded, all_ids = [], [], [], []
            for text in part["text"]:
                found = coder.encode(text)
                ids = found.tolist()
                counts.append(len(ids))
                digests.append(hashlib.sha256(b",".join(map(decimal, ids))).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(found)
            out = {"_id": part["_id"], "n_tokens": counts, "ids_sha256": digests, "decoded_sha256": decoded}
            yield pd.DataFrame(out | ({"ids": all_ids} if with_ids else {}))

    source = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return source.mapInPandas(run, schema).withColumnRenamed("_id", id_col)
