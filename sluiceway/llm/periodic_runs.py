"""Runs of periodic words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4q) words long, that
no neighbouring word extends. At scale t (a power of two) the synchronising set holds position i if
the least hash among the t-word substrings that begin at i..i+t is that of i or of i+t. Whether i is in
the set depends on the 2t words from i only, so equal contexts make equal choices. A run of a period
t <= q < 2t holds a chosen position among its first t, and that position plus q is chosen too; no
equal context lies between them. So neighbours in the order of (context, position) whose distance
is in [t, 2t) propose every such period, and a look at the longest common stretches on both sides turns
a proposal into the maximal run. Substrings of a period of at most t/4 take no part in the minima, as
they would fill the set: their regions are the runs that smaller scales have found already. Periods
of 1 to 3 words are compared directly.

Contexts are compared by exact names (pairs of names of half their length, numbered), never by
hashes alone, so nothing is lost or made up.

Per document: null text counts as empty; without words there is no run, the digests are those of
empty strings; a null id stays null and is never rewritten. Long texts are taken whole: work is
n log n in the words, memory is about 4 bytes per word and scale for documents that repeat eight words,
less for others. Repeated rows are answered each for itself; extra columns are ignored; an empty table
gives no rows. Ties go to the smallest start, then the smallest period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluiceway.llm.common import by_value, map_batches, whole_text

LEAST, TIMES = 6, 4  # words, and periods, of the shortest run
TOGETHER = 1 << 20  # words of documents looked at together
DIRECT = 3  # periods compared word by word
_NEVER = np.uint64(2**64 - 1)


def stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def direct_runs(words: np.ndarray) -> list[np.ndarray]:
    """Runs (start, end, period) of periods up to DIRECT."""
    found = []
    for q in range(1, DIRECT + 1):
        if len(words) <= q:
            break
        start, end = stretches(words[:-q] == words[q:])
        long = end - start + q >= max(LEAST, TIMES * q)
        start, end = start[long], end[long] + q
        if q > 1:
            # Periods of 2 and 3 are smallest unless all words are the same.
            constant = words[start] == words[start + 1]
            if q == 3:
                constant &= words[start + 1] == words[start + 2]
            start, end = start[~constant], end[~constant]
        found.append(np.column_stack((start, end, np.full(len(start), q))))
    return found


def mixed(names: np.ndarray) -> np.ndarray:
    """A fixed scattering of 64-bit numbers, one to one."""
    h = names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def may_repeat(words: np.ndarray, width: int = 8) -> np.ndarray:
    """Positions whose ``width`` words (a power of two) may begin elsewhere too; none that does is missed."""
    h, step = mixed(words), 1
    while step < width:
        if len(h) <= step:
            return np.empty(0, np.int64)
        h = mixed(h[:-step] * np.uint64(3) + h[step:])
        step *= 2
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    return order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(h) > 1 else order[:0]


def names_by_scale(words: np.ndarray) -> list[np.ndarray]:
    """Names of the substrings of 1, 2, 4, … words at every position, until no two are equal.

    Equal names stand for equal substrings; what would reach beyond the end has a name of its own.
    """
    n, levels, width = len(words), [], 1
    now = np.unique(words, return_inverse=True)[1].astype(np.int32)
    while True:
        levels.append(now)
        if width >= n or int(now.max()) == n - 1:
            return levels
        whole = n - 2 * width + 1
        pairs = now[: max(whole, 0)].astype(np.int64) * n + now[width : width + max(whole, 0)]
        made = np.unique(pairs, return_inverse=True)[1]
        first = int(made.max()) + 1 if len(made) else 0
        rest = np.arange(first, first + n - len(made))
        now = np.concatenate((made, rest)).astype(np.int32)
        width *= 2


def common_stretch(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words from a and b on (or, not ``ahead``, before them) agree; a < b."""
    n, a, b = len(levels[0]), a.copy(), b.copy()
    got = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        if ahead:
            fits = b + width <= n
            at_a, at_b = a[fits], b[fits]
        else:
            fits = a >= width
            at_a, at_b = a[fits] - width, b[fits] - width
        same = np.zeros(len(a), bool)
        same[fits] = levels[k][at_a] == levels[k][at_b]
        got[same] += width
        move = width if ahead else -width
        a[same] += move
        b[same] += move
    return got


def synchronising(names: np.ndarray, scale: int, omitted: np.ndarray) -> np.ndarray:
    """The positions of the synchronising set of ``scale``; ``omitted`` ones take no part in the minima."""
    n = len(names)
    if n < 2 * scale:
        return np.empty(0, np.int64)
    ids = mixed(names[: n - scale + 1])
    ids[omitted[: len(ids)]] = _NEVER
    low, width = ids, 1
    while width < scale:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    # Minima over scale + 1 places from every i whose 2 * scale words are within the text.
    low = np.minimum(low[: n - 2 * scale + 1], ids[scale:])
    chosen = ((ids[: len(low)] == low) | (ids[scale:] == low)) & (low != _NEVER)
    return np.flatnonzero(chosen)


def covered(runs: np.ndarray, n: int, scale: int) -> np.ndarray:
    """Positions whose ``scale`` words lie within one of ``runs``."""
    steps = np.zeros(n + 1, np.int32)
    last = runs[:, 1] - scale + 1
    fits = last > runs[:, 0]
    np.add.at(steps, runs[fits, 0], 1)
    np.add.at(steps, last[fits], -1)
    return np.cumsum(steps[:n]) > 0


def larger_runs(words: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Runs of periods beyond DIRECT, given those within it; all (start, end, period)."""
    levels, n = names_by_scale(words), len(words)
    found = small
    for k in range(2, len(levels) - 1):
        scale = 1 << k
        omitted = np.zeros(n, bool)
        if scale >= 8:
            omitted = covered(found[found[:, 2] <= scale // 4], n, scale)
        chosen = synchronising(levels[k], scale, omitted)
        order = np.lexsort((chosen, levels[k + 1][chosen]))
        p = chosen[order]
        context = levels[k + 1][p]
        near = np.flatnonzero(context[1:] == context[:-1])
        period = p[near + 1] - p[near]
        proposes = (period >= scale) & (period < 2 * scale)
        p, period = p[near][proposes], period[proposes]
        if not len(p):
            continue
        start = p - common_stretch(levels, p, p + period, ahead=False)
        end = p + period + common_stretch(levels, p, p + period, ahead=True)
        long = end - start >= np.maximum(LEAST, TIMES * period)
        made = np.column_stack((start, end, period))[long]
        found = np.concatenate((found, np.unique(made, axis=0)))
    return found[len(small) :]


def runs_of(texts: list[list]) -> Iterator[np.ndarray]:
    """For every list of words its runs (start, length, period), by start, then period."""
    at = 0
    while at < len(texts):
        upto, total = at, 0
        while upto < len(texts) and (upto == at or total + len(texts[upto]) <= TOGETHER):
            total += len(texts[upto])
            upto += 1
        yield from _runs_together(texts[at:upto], total)
        at = upto


def _runs_together(texts: list[list], total: int) -> list[np.ndarray]:
    """``runs_of`` for texts whose words are numbered apart, so that nothing crosses from one to the next."""
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    words = np.empty(total, np.int32)
    base = 0
    for words_of, start in zip(texts, bounds):
        known: dict = {}
        number = known.setdefault
        words[start : start + len(words_of)] = [number(w, base + len(known)) for w in words_of]
        base += len(known)
    found = direct_runs(words)
    # Longer periods repeat eight words; only texts that do are looked at further, as one.
    again = np.unique(np.searchsorted(bounds, may_repeat(words), side="right") - 1)
    if len(again):
        small = np.concatenate(found)
        part = np.concatenate([words[bounds[d] : bounds[d + 1]] for d in again])
        own = np.concatenate(([0], np.cumsum(bounds[again + 1] - bounds[again])))
        shift = bounds[again] - own[:-1]
        text = np.searchsorted(bounds, small[:, 0], side="right") - 1
        place = np.searchsorted(again, text)
        held = (place < len(again)) & (again[np.minimum(place, len(again) - 1)] == text)
        moved = small[held].copy()
        moved[:, :2] -= shift[place[held]][:, None]
        larger = larger_runs(part, moved)
        back = shift[np.searchsorted(own, larger[:, 0], side="right") - 1]
        larger[:, :2] += back[:, None]
        found.append(larger)
    if not found:
        return [np.empty((0, 3), np.int64) for _ in texts]
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    cut = np.searchsorted(runs[:, 0], bounds)
    out = []
    for i in range(len(texts)):
        own = runs[cut[i] : cut[i + 1]]
        out.append(np.column_stack((own[:, 0] - bounds[i], own[:, 1] - own[:, 0], own[:, 2])))
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; ties go to the smallest start, then period."""
    if not len(runs):
        return None
    s, length, q = max(runs.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return s, length, q


def find(docs: DataFrame, change: Callable[[list[bytes], object], list[bytes]] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period) and the text without repeats.

    ``change`` may replace the words of a row, given its words and id. A narrow map: no shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = _words(batch, change)
        made, kept = [], []
        for words, runs in zip(texts, runs_of(texts)):
            made.append([dict(zip(("start", "length", "period"), r)) for r in runs.tolist()])
            kept.append(b" ".join(collapsed(words, runs)).decode("utf-8", "replace"))
        struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        columns = [
            batch.column(0),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array(made, pa.list_(struct)),
            pa.array(kept, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_batches(rows, look, schema)


def summarised(docs: DataFrame, change: Callable[[list[bytes], object], list[bytes]] | None = None) -> DataFrame:
    """Per row: doc_id, n_runs, the strongest run and digests of all runs and of the collapsed words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = _words(batch, change)
        made = []
        for words, runs in zip(texts, runs_of(texts)):
            best = strongest(runs)
            lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs.tolist())
            made.append((
                len(runs),
                *(best or (None, None, None)),
                1000 * best[1] // best[2] if best else None,
                hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
            ))
        types = [pa.int64()] * 5 + [pa.string()] * 2
        columns = [pa.array(list(c), t) for c, t in zip(zip(*made), types)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    rows = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:6]) + ", runs_sha256 string, collapsed_sha256 string"
    return map_batches(rows, look, schema)


def _words(batch: pa.RecordBatch, change) -> list[list[bytes]]:
    # Splitting bytes without a separator splits at space and \x09 to \x0D, nothing else.
    texts = [t.split() for t in batch.column(1).to_pylist()]
    return [change(t, i) for t, i in zip(texts, batch.column(0).to_pylist())] if change else texts


def tail_repeated(words: list[bytes], doc_id: object) -> list[bytes]:
    """For a tenth of the ids, by their hash: the words from some place on repeat a stretch of their own."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + [period[i % p] for i in range(n - a)]


by_value(__name__)
