"""Fill-in-middle rewriting of texts, cut between units of white space and word.

A Split pre-tokenizer of the tokenizers library, which needs no training, isolates every match of the unit
pattern and gives its code-point offsets.  The length of the offset array is the number of units n; two hashes of
the document's id rank two of its n + 1 boundaries, and the text's slices between them are prefix, middle and
suffix, written in the order psm or spm with a mark before each.  `restore` rebuilds the text from output and
form alone.

Long texts are split in pieces of about `PIECE` code points that end where a unit ends, so only the offsets of a
whole text are held at once.

Defined cases: a null text is an empty one, which is plain (as is any text that contains a mark); a null id is hashed as
the empty string; texts of any length are cut whole; repeated rows give the same output; an empty table gives no
rows; both cuts may fall together, which leaves the middle empty; extra columns are kept, but for those named as the
new ones, which are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from starloom.llm.common import SPACES, map_rows

UNIT = rf"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+"
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PIECE = 1 << 18
COLUMNS = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


def unit_offsets() -> Callable[[str], np.ndarray]:
    """A function from a text to the n + 1 boundaries of its units, in code points."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(UNIT), behavior="isolated")
    unit_ends = re.compile(rf"(?<=[^{SPACES}])[{SPACES}]")

    def offsets(text: str) -> np.ndarray:
        found, at = [np.zeros(1, np.int64)], 0
        while at < len(text):
            end = unit_ends.search(text, at + PIECE)
            piece = text[at : end.start() if end else len(text)]
            found.append(np.array([stop for _, (_, stop) in split.pre_tokenize_str(piece)], np.int64) + at)
            at += len(piece)
        return np.concatenate(found)

    return offsets


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def rewrite(text: str, offsets: np.ndarray, h: tuple[int, int, int, int], rate: int, spm_rate: int) -> tuple[str, int | None, int | None, str]:
    """(form, prefix_chars, middle_chars, output)."""
    if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= rate:
        return "plain", None, None, text
    a, b = (int(offsets[k]) for k in sorted((h[0] % len(offsets), h[1] % len(offsets))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_rate:
        return "spm", len(prefix), len(middle), f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return "psm", len(prefix), len(middle), f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text of an output; no part holds a mark, and a mark can't arise where a part meets one."""
    if form == "plain":
        return output
    if form not in ("psm", "spm"):
        raise ValueError(f"unknown form {form!r}")
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    start, rest = output.split(second, 1)
    end, middle = rest.split(MIDDLE, 1)
    if not start.startswith(first):
        raise ValueError(f"an output of form {form} starts with {first}")
    start = start[len(first) :]
    return start + middle + end if form == "psm" else end + middle + start


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars (null if plain) and output; `rate` per cent of texts are rewritten, of these `spm_rate` per cent as spm."""
    df = df.select(*(c for c in df.columns if c.lower() not in COLUMNS))
    at_key, at_text = df.columns.index(key), df.columns.index(text)

    def make():
        offsets_of = unit_offsets()

        def one(doc_id: int | None, t: str) -> tuple:
            offsets = offsets_of(t)
            return len(offsets) - 1, *rewrite(t, offsets, draws(doc_id, seed), rate, spm_rate)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [one(d, t or "") for d, t in zip(batch.column(at_key).to_pylist(), batch.column(at_text).to_pylist())]
            new = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *COLUMNS])

        return run

    schema = StructType(list(df.schema))  # a copy, as add() changes it
    for name, kind in COLUMNS.items():
        schema.add(name, kind)
    return map_rows(df, make, schema)


def restored(df: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Add the text rebuilt from output and form."""
    df = df.select(*(c for c in df.columns if c.lower() != name.lower()))
    at_output, at_form = df.columns.index(output), df.columns.index(form)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [restore(o, f) for o, f in zip(batch.column(at_output).to_pylist(), batch.column(at_form).to_pylist())]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

        return run

    return map_rows(df, make, StructType(list(df.schema)).add(name, "string"))
