"""Language ID by rank-order profiles.

Learning counts all n-grams (n = 1..3, letters with their word borders, lower
case) of all training texts of each language; a language's profile is its
``profile`` most frequent ones in order.  A document's most frequent n-grams of
those that any profile knows are ranked likewise, and its distance to a language
is the sum over them of how far each is out of place (the profile's length where
the language lacks it).  The nearest language wins, ties go to the first by name.

Counts are added up in tasks and then over languages and n-grams, so nothing
that grows with the documents reaches the driver: profiles hold at most
``profile`` n-grams a language.

Edge cases: null texts and texts without a letter are ``und`` with score 0; a
text whose n-grams no profile knows goes to the first language with score 0;
without training rows everything is ``und``.  With ``told`` a filter drops all
texts of score 0, or without training rows those without a letter.  Rows without language, text or id
are not learned from; a null id is not held out.  Repeated rows count repeatedly;
extra columns pass through, and lang_pred and score stand for any of their names.
Memory follows the longest text.  n-grams of a document that no profile knows are
left out before ranking: they would be as far out of place for every language, and
so would only crowd out those that tell languages apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import replaced, slices
from .tokens import LETTER, _tables, code_points

PROFILE = 400
DOCUMENT = 300
BITS = 21
UNKNOWN = "und"


@lru_cache(1)
def folded() -> np.ndarray:
    """Lower case of every code point's letter, a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for cp in np.flatnonzero(_tables()[0] == LETTER).tolist():
        low = chr(cp).lower()
        table[cp] = ord(low) if len(low) == 1 else cp
    return table


def spread(offsets: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded code points with two spaces around every text, row of each, letters of each row)."""
    at, cp, _ = code_points(offsets, body)
    n = len(at) - 1
    rows = np.repeat(np.arange(n), np.diff(at))
    out = np.full(len(cp) + 2 * n + 2, 32, np.uint32)
    place = np.arange(len(cp)) + 2 * rows + 2
    out[place] = folded()[cp]
    where = np.zeros(len(out), np.int64)
    where[place] = rows
    # Spaces between texts go with the text before; grams across hold both spaces and are left out.
    where = np.maximum.accumulate(where)
    letters = np.bincount(rows, weights=_tables()[0][cp] == LETTER, minlength=n)
    return out, where, letters


def grams(letters: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams of all widths up to 3 as packed numbers, index of their middle or first letter)."""
    x = letters.astype(np.int64)
    solid = x != 32
    one = np.flatnonzero(solid)
    pair = np.flatnonzero(solid[:-1] | solid[1:])
    three = np.flatnonzero(solid[1:-1])
    keys = [x[one], x[pair] << BITS | x[pair + 1], x[three] << 2 * BITS | x[three + 1] << BITS | x[three + 2]]
    # The first letter of a pair is a space only before a word.
    places = [one, pair + ~solid[pair], three + 1]
    return np.concatenate(keys[:width]), np.concatenate(places[:width])


def counts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n): n-grams of all texts by language; each task sends each n-gram once or so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([c for _, c in held])[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            return keys[first], np.add.reduceat(n, first)

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, index in names.items():
                own = [(k, c) for i, k, c in per_lang if i == index]
                if own:
                    held[:] = own
                    k, c = merged()
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(c.astype(np.int64))], ["lang", "gram", "n"])
            per_lang.clear()

        per_lang: list[tuple[int, np.ndarray, np.ndarray]] = []
        for rows, offsets, body in slices(batches, "text"):
            langs = rows.column(1).to_pylist()
            index = np.array([names.setdefault(x, len(names)) for x in langs], np.int64)
            letters, where, _ = spread(offsets, body)
            keys, places = grams(letters, 3)
            of = index[where[places]]
            for i in np.unique(index).tolist():
                k, c = np.unique(keys[of == i], return_counts=True)
                per_lang.append((i, k, c))
                size += len(k)
            if size > 1_500_000:
                yield from sent()
                size = 0
        if per_lang:
            yield from sent()

    kept = df.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return kept.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Profiles:
    langs: list[str]
    grams: np.ndarray  # sorted
    ranks: np.ndarray  # langs x grams; the profile's length where a language lacks one
    length: int

    def __post_init__(self) -> None:
        parts = {int(g) >> s & (1 << BITS) - 1 for g in self.grams for s in (0, BITS, 2 * BITS)}
        symbols = sorted(parts - {0})
        self.symbol = None
        self.base = len(symbols) + 1
        if self.base <= 220:  # else by search
            self.symbol = np.zeros(0x110000, np.int32)
            self.symbol[symbols] = np.arange(1, self.base)
            self.table = np.full(self.base**3, -1, np.int16 if len(self.grams) < 32768 else np.int32)
            code = np.zeros(len(self.grams), np.int64)
            for s in (2 * BITS, BITS, 0):
                code = code * self.base + self.symbol[self.grams >> s & (1 << BITS) - 1]
            self.table[code] = np.arange(len(self.grams))

    def find(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of each known n-gram, its place)."""
        if self.symbol is None:
            keys, places = grams(letters, 3)
            at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
            known = self.grams[at] == keys
            return at[known], places[known]
        s = self.symbol[letters]
        solid = letters != 32
        one = np.flatnonzero(solid)
        pair = np.flatnonzero(solid[:-1] | solid[1:])
        three = one[(one > 0) & (one < len(s) - 1)]
        # A symbol that no profile knows must not pass for a shorter n-gram.
        two_ok = (s[pair] > 0) & (s[pair + 1] > 0)
        three_ok = (s[three - 1] > 0) & (s[three] > 0) & (s[three + 1] > 0)
        pair, three = pair[two_ok], three[three_ok]
        index = np.concatenate([self.table[s[one]], self.table[s[pair] * self.base + s[pair + 1]], self.table[(s[three - 1] * self.base + s[three]) * self.base + s[three + 1]]]).astype(np.int64)
        places = np.concatenate([one, pair + ~solid[pair], three])
        known = index >= 0
        return index[known], places[known]

    def told(self, offsets: np.ndarray, body: np.ndarray) -> np.ndarray:
        """Whether each text has an n-gram that a profile knows, or a letter if there are no profiles."""
        return self.nearest(offsets, body)[1] > 0 if self.langs else spread(offsets, body)[2] > 0

    def nearest(self, offsets: np.ndarray, body: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text."""
        n, size = len(offsets) - 1, len(self.grams)
        if not self.langs:
            return [UNKNOWN] * n, np.zeros(n)
        letters, where, found = spread(offsets, body)
        index, places = self.find(letters)
        names, scores = [], np.zeros(n)
        cell = where[places] * size + index
        number = np.bincount(cell, minlength=n * size).reshape(n, size)
        for a in range(0, n, 256):
            part = number[a : a + 256]
            order = np.argsort(-part, axis=1, kind="stable")
            rank = np.empty_like(order)
            np.put_along_axis(rank, order, np.arange(size)[None, :], axis=1)
            used = (part > 0) & (rank < DOCUMENT)
            total = used.sum(1)
            far = np.stack([(np.abs(rank - own) * used).sum(1) for own in self.ranks], 1)
            best = far.argmin(1)
            # At worst every n-gram is a whole profile out of place.
            worst = np.maximum(1, total * max(self.length, DOCUMENT))
            scores[a : a + 256] = np.where(total > 0, 1 - far[np.arange(len(best)), best] / worst, 0)
            names += [self.langs[i] for i in best]
        for i in np.flatnonzero(found == 0).tolist():
            names[i], scores[i] = UNKNOWN, 0.0
        return names, np.clip(scores, 0, 1)


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> Profiles:
    """Profiles of every language in df, over all its rows; at most ``profile`` n-grams a language reach the driver."""
    found = counts(df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()), text_col, lang_col)
    # Two ranks, so that no task holds all n-grams of a large language.
    part = Window.partitionBy("lang", F.pmod(F.hash("gram"), F.lit(16))).orderBy(F.desc("n"), "gram")
    whole = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = found.withColumn("r", F.row_number().over(part)).where(F.col("r") <= profile).withColumn("r", F.row_number().over(whole)).where(F.col("r") <= profile)
    rows = top.select("lang", "gram", "r").collect()
    langs = sorted({r.lang for r in rows})
    known = np.array(sorted({r.gram for r in rows}), np.int64)
    ranks = np.full((len(langs), len(known)), profile, np.int64)
    for r in rows:
        ranks[langs.index(r.lang), np.searchsorted(known, r.gram)] = r.r - 1
    return Profiles(langs, known, ranks, profile)


def training(id_col: Column) -> Column:
    """Rows to learn from: all but a third by crc32 of the id."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 != 1


def predict(df: DataFrame, profiles: Profiles, text_col: str = "text", keep: bool = False, told: bool = False) -> DataFrame:
    """df without its text, with lang_pred and score; with ``keep``, df's own columns, without the rows of no language or, with ``told``, those that no profile tells anything of."""
    places, schema = replaced(df, text_col, ("lang_pred", "string"), ("score", "double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, text_col):
            if keep and told:
                yield rows.filter(pa.array(profiles.told(offsets, body)))
                continue
            langs, scores = profiles.nearest(offsets, body)
            if keep:
                yield rows.filter(pa.array([x != UNKNOWN for x in langs]))
            else:
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in places), pa.array(langs, pa.string()), pa.array(scores)], schema.names)

    return df.mapInArrow(run, df.schema if keep else schema)
