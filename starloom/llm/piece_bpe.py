"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The distinct words of an Arrow slice lie in one flat numpy array of symbol ids.  A round looks up the
rank of every adjacent pair, takes the minimum of each word (segmented reduction), merges its leftmost
occurrence, and in the same round all further non-overlapping ones where that cannot change the result,
and compacts the array.  Words without a pair leave; the rounds end when none remains.

Long words would need a round for nearly every merge.  In them a round also merges each pair whose two outer
boundaries are guarded: the guard of a boundary is the least rank of any piece that contains the symbols at
its two sides as they stand.  Every later merge over the boundary makes such a piece, so a pair of a
lesser rank than its guards is merged before either neighbour is touched, whatever happens elsewhere.  A boundary
without such a piece parts the word into two that have nothing to do with each other.

Defined cases: a null text is empty; an empty text has only the end id; a text of any length is coded whole; characters
outside the vocabulary become byte pieces; an empty table gives no rows; repeated rows, ties and extra columns don't
matter, as every row is coded on its own.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memo, map_rows

MARK = "▁"
#: Where no piece has the mark after another character, a word starts at each mark that follows one.
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words of more characters also use guards.
LONG = 200

#: The rank of a pair that no piece joins.
NONE = np.iinfo(np.int64).max


class PieceCoder:
    """Symbols below the vocabulary's size are its pieces; characters outside it get ids above, within one call."""

    def __init__(self, path: str, memo: int = 100_000) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.eos = model.get_piece_size(), model.eos_id()
        pieces = {}
        self.bytes_of = [b""] * self.size
        self.byte_ids = [model.unk_id()] * 256
        for i in range(self.size):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(p[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[p] = i
                self.bytes_of[i] = p.replace(MARK, " ").encode("utf-8")
        self.symbol_of = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        for p, i in pieces.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        _, rank = np.unique([-model.get_score(i) for i in range(self.size)], return_inverse=True)
        pairs = [
            (pieces[p[:k]] * self.size + pieces[p[k:]], i) for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces
        ]
        keys, merged = np.array(pairs or [(-2, -1)], np.int64).T  # at least one entry, which no pair of symbols equals
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order]
        self.rank = rank.astype(np.int64)
        # A piece is safe if no pair with it outranks it: then its merges at other places of a word wait for nothing.
        self.safe = np.ones(self.size, bool)
        for part in (self.keys // self.size, self.keys % self.size):
            self.safe[part[self.rank[self.merged] <= self.rank[part]]] = False
        self.memo = Memo(memo)
        self.pieces = pieces
        self.names = {i: p for p, i in pieces.items()}
        self.spanned: dict[str, int] = {}
        self.guards = Memo(memo)
        # a vocabulary with marks inside its pieces has no words: its texts are coded whole
        self.split = SEGMENT.findall if not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) else lambda t: [t]

    def _guards(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The least rank of a piece with the symbols at and after the places `at` in a row; NONE if there is none."""
        if not self.spanned:  # of every string inside a piece the least rank of such a piece; built for the first long word
            for p, i in self.pieces.items():
                r = int(self.rank[i])
                for a in range(len(p) - 1):
                    for b in range(a + 2, len(p) + 1):
                        if self.spanned.get(p[a:b], NONE) > r:
                            self.spanned[p[a:b]] = r
        after = np.minimum(at + 1, sym.size - 1)
        left, right = sym[at], sym[after]
        fits = (after > at) & (left < self.size) & (right < self.size) & (word[at] == word[after])
        keys, place = np.unique(np.where(fits, left * self.size + right, -1), return_inverse=True)
        found = []
        for key in keys.tolist():
            guard = self.guards.get(key)
            if guard is None:
                self.guards.make_room(1)
                a, b = divmod(key, self.size)
                guard = self.guards[key] = NONE if key < 0 else self.spanned.get(self.names[a] + self.names[b], NONE)
            found.append(guard)
        return np.array(found, np.int64)[place]

    def _pairs(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, rank) that the symbols at and after the places `at` merge to; -1 and NONE where they don't."""
        after = np.minimum(at + 1, sym.size - 1)
        left, right = sym[at], sym[after]
        fits = (after > at) & (left < self.size) & (right < self.size) & (word[at] == word[after])
        key = np.where(fits, left * self.size + right, -1)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[place] == key
        made = np.where(hit, self.merged[place], -1)
        return made, np.where(hit, self.rank[made], NONE)

    def merge_words(self, words: list[str]) -> list[list[int]]:
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.symbol_of[points].astype(np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        place, done_sym, done_place = np.arange(sym.size), [], []
        starts = np.cumsum([0, *map(len, words)])
        made, rank = self._pairs(sym, word, np.arange(sym.size))
        guarded = any(len(w) > LONG for w in words)
        guard = self._guards(sym, word, np.arange(sym.size)) if guarded else rank
        while sym.size:
            parted = word[1:] != word[:-1]
            first = np.flatnonzero(np.append(True, parted | (guard[:-1] == NONE) if guarded else parted))
            lengths = np.diff(np.append(first, sym.size))
            if guarded:
                word = np.repeat(np.arange(len(first)), lengths)
            best = np.minimum.reduceat(rank, first)
            active = np.repeat(best < NONE, lengths)
            if not active.all():
                done_sym.append(sym[~active])
                done_place.append(place[~active])
            if not active.any():
                break
            # leftmost pair of the least rank in each word, and equal pieces further on
            cand = np.flatnonzero((rank == np.repeat(best, lengths)) & active)
            seg = np.searchsorted(first, cand, side="right")
            head = np.append(True, seg[1:] != seg[:-1])
            lead = made[cand[np.maximum.accumulate(np.where(head, np.arange(len(cand)), 0))]]
            keep = head | ((made[cand] == lead) & self.safe[lead])
            cand = cand[keep]
            # of a run of overlapping pairs every second one, from the left
            run = np.append(True, np.diff(cand) != 1)
            nth = np.arange(len(cand)) - np.maximum.accumulate(np.where(run, np.arange(len(cand)), 0))
            cand = cand[nth % 2 == 0]
            if guarded:
                before, after = np.append(NONE, guard[:-1]), np.append(guard[1:], NONE)
                cand = np.union1d(cand, np.flatnonzero((rank < before) & (rank <= after) & (rank < NONE)))
            sym[cand] = made[cand]
            active[cand + 1] = False
            # only the pairs on both sides of a merged symbol are looked up again
            moved = np.cumsum(active)[cand] - 1
            sym, word, place, made, rank = sym[active], word[active], place[active], made[active], rank[active]
            touched = np.concatenate((moved, moved[moved > 0] - 1))
            made[touched], rank[touched] = self._pairs(sym, word, touched)
            guard = guard[active] if guarded else rank
            if guarded:
                guard[touched] = self._guards(sym, word, touched)
        order = np.argsort(place := np.concatenate(done_place), kind="stable")
        sym, place = np.concatenate(done_sym)[order], place[order]
        word = np.searchsorted(starts, place, side="right") - 1
        ids = sym.tolist()
        ends = np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        coded = [ids[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.unique(word[sym >= self.size]).tolist():
            coded[i] = self._bytes(coded[i])
        return coded

    def _bytes(self, ids: list[int]) -> list[int]:
        """Characters outside the vocabulary as byte pieces."""
        return [j for i in ids for j in ([i] if i < self.size else (self.byte_ids[b] for b in chr(i - self.size).encode("utf-8", "surrogatepass")))]

    def encode(self, texts: list[str | None], eos: bool = True) -> list[list[int]]:
        split = [self.split((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        words = set().union(*split)
        new = list(words - self.memo.keys())
        self.memo.make_room(len(new))
        wanted = new if self.memo else list(words)
        if wanted:
            self.memo.update(zip(wanted, self.merge_words(wanted)))
        end = [self.eos] if eos else []
        out = [[*itertools.chain.from_iterable(map(self.memo.__getitem__, ws)), *end] for ws in split]
        for w in wanted:  # long words seldom come again
            if len(w) > 64:
                del self.memo[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, the word-start mark as a space, without the space that encoding put in front."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row."""

    def make():
        coder = PieceCoder(path)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = coder.encode(b.column(1).to_pylist())
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(coder.decode, ids), pa.string())], names=["doc_id", "ids", "decoded"]
            )

        return run

    return map_rows(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), make, "doc_id long, ids array<int>, decoded string", 1 << 20)


def digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
