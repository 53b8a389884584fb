"""Fill-in-the-middle transformation over an indexable skip list.

A text is cut into units (a word with the white space before it, or white space
at the end); the units are the bottom lane of a skip list. Every lane above links
runs of ``FAN`` links of the lane below, and every link carries two widths: how
many units and how many code points it spans. To reach a cut rank the search
starts on the top lane, runs along it while the accumulated unit width does not
pass the rank, and descends; the accumulated code-point width is then the place
in the text. A lane is searched over at most ``FAN`` links, so a cut costs some
``FAN`` * log(n) steps and the text is sliced once.

Texts are judged one by one where they lie: no shuffle, and a lost executor
repeats its own rows only.

Defined results: a null or empty text is ``plain`` with no unit and stays empty; a
text that already holds a marker is ``plain``; a text of white space alone is one
unit; a null id is hashed as the empty decimal; repeated rows stay; other columns
are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Links of one lane that a link of the next lane spans.
FAN = 16
#: Markers of the three parts (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: ASCII white space: blank and 9 to 13.
_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_widths(text: str) -> np.ndarray:
    """Code points of every unit, in order: white space and the word after it, or
    the white space that ends the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = _SPACE[np.minimum(points, 127)]
    blank[points > 127] = False
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    ends = np.append(ends, len(points)) if len(points) else ends
    return np.diff(ends, prepend=0)


class SkipList:
    """Lanes of (unit widths, code-point widths), bottom lane first."""

    def __init__(self, widths: np.ndarray):
        units, points = np.ones(len(widths), np.int64), widths.astype(np.int64)
        self.lanes = [(units, points)]
        while len(units) > FAN:
            starts = np.arange(0, len(units), FAN)
            units, points = np.add.reduceat(units, starts), np.add.reduceat(points, starts)
            self.lanes.append((units, points))

    def locate(self, rank: int) -> int:
        """Code points before the unit of that rank (from 0; the number of units
        gives the whole length)."""
        at = passed = place = 0
        for units, points in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed, place, at = passed + int(units[at]), place + int(points[at]), at + 1
            at *= FAN  # the same place on the lane below
        return place


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 that the document's id determines."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id: int | None, text: str, rate: int, spm_rate: int, seed: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    widths = unit_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    lanes = SkipList(widths)
    first, second = sorted((lanes.locate(h1 % (n + 1)), lanes.locate(h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_rate:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, first, second - first, output


def restore(form: str, output: str) -> str:
    """The exact text of an output. A text that held a marker was left plain, so
    each marker stands once, and none can arise where a part meets a marker."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, middle = output.removeprefix(first).split(MIDDLE)
    a, b = head.split(second)
    prefix, suffix = (a, b) if form == "psm" else (b, a)
    return prefix + middle + suffix


def fill_in_middle(
    documents: DataFrame, rate: int = 50, spm_rate: int = 80, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm),
    prefix_chars, middle_chars (code points; null if plain), output (text).

    ``rate`` per cent of the documents are rearranged, ``spm_rate`` per cent of
    those with the suffix first; cuts and choices follow from (seed, doc_id).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = [int(i) if isinstance(i, str) else None for i in frame["id"]]
            rows = [(i, *transform(i, t if isinstance(t, str) else "", rate, spm_rate, seed)) for i, t in zip(ids, frame["text"], strict=True)]
            out = pd.DataFrame(rows, columns=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"], dtype=object)
            yield out.astype({"doc_id": "Int64", "n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # The id goes over as text: a column of integers with nulls would become one of floats.
    return documents.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, SCHEMA)


def digests(made: DataFrame) -> DataFrame:
    """``fill_in_middle`` with the digests of the output and of the text that is
    rebuilt from output and form, in the place of the output."""

    @F.pandas_udf("string")
    def restored(form: pd.Series, output: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(restore(f, o).encode("utf-8", "surrogatepass")).hexdigest() for f, o in zip(form, output, strict=True)], dtype=object)

    return made.withColumns({"output_sha256": F.sha2("output", 256), "restored_sha256": restored("form", "output")}).drop("output")
