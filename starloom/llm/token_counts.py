"""Word-piece token counts by a linear longest-match automaton.

A trie of the vocabulary gets, for every node, a failure link and the number of tokens popped when
the match falls back over that link.  One pass over a word then gives the length of its greedy
longest-match tokenization; no piece is ever cut out or looked up.

Defined cases: a null or empty text has no words and no tokens; characters outside the vocabulary
count as one token per UTF-8 byte; a text of any length is counted whole, in linear time; an empty table gives no
rows; repeated rows are counted each on its own; extra columns are kept by `count_tokens`, but for those named
n_words or n_tokens, which are replaced.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, Memo, map_rows


class LongestMatchCounter:
    """Greedy longest-match lengths; `weight` of an unmatched character is its UTF-8 length."""

    def __init__(self, vocabulary: Iterable[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        is_piece = [False]
        for piece in vocabulary:
            node = 0
            for ch in piece:
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    is_piece.append(False)
                node = nxt
            is_piece[node] = node > 0
        self.fail, self.popped = [0] * len(self.children), [0] * len(self.children)
        queue = deque([0])
        while queue:  # breadth first: a failure link always leads to a shorter string
            parent = queue.popleft()
            for ch, node in self.children[parent].items():
                if is_piece[node]:
                    self.popped[node] = 1
                elif not parent:  # a first character that is no piece itself falls back to its bytes
                    self.popped[node] = len(ch.encode("utf-8", "surrogatepass"))
                else:
                    self.fail[node], extra = self._step(self.fail[parent], ch)
                    self.popped[node] = self.popped[parent] + extra
                queue.append(node)

    def _step(self, node: int, ch: str) -> tuple[int, int]:
        """The node after `ch`, and the tokens popped on the way."""
        count = 0
        while True:
            nxt = self.children[node].get(ch)
            if nxt is not None:
                return nxt, count
            if node == 0:
                return 0, count + len(ch.encode("utf-8", "surrogatepass"))
            count += self.popped[node]
            node = self.fail[node]

    def count(self, word: str) -> int:
        node = total = 0
        for ch in word:
            node, popped = self._step(node, ch)
            total += popped
        while node:
            total += self.popped[node]
            node = self.fail[node]
        return total


def load_vocabulary(path: str) -> list[str]:
    """Ordinary pieces of a SentencePiece model; the word-start mark stays part of a piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


def count_tokens(df: DataFrame, vocabulary_path: str, text: str = "text", mark: str = "▁", memo: int = 200_000) -> DataFrame:
    """Add `n_words` and `n_tokens` (long): ASCII-space words, each tokenized with `mark` before it."""
    df = df.drop("n_words", "n_tokens")
    schema = df.withColumns({"n_words": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema
    at = df.columns.index(text)

    def make():
        counter, word, seen = LongestMatchCounter(load_vocabulary(vocabulary_path)), re.compile(WORD), Memo(memo)

        def counts(texts: list[str | None]) -> tuple[list[int], list[int]]:
            n_words, n_tokens = [], []
            for t in texts:
                words = word.findall(t or "")
                total = 0
                for w in words:
                    n = seen.get(w)
                    if n is None:
                        n = counter.count(mark + w)
                        if len(w) <= 64:  # longer words are not kept, which bounds the memo's bytes
                            seen.make_room(1)
                            seen[w] = n
                    total += n
                n_words.append(len(words))
                n_tokens.append(total)
            return n_words, n_tokens

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, tokens = counts(batch.column(at).to_pylist())
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[*batch.schema.names, "n_words", "n_tokens"])

        return run

    return map_rows(df, make, schema)
