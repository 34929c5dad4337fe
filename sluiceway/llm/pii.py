"""Personal data by fixed patterns and a character tagger.

The tagger is a character-level bidirectional LSTM whose scores feed a linear-chain CRF, both trained
here in numpy on windows around labelled spans (the base patterns' findings in a bounded sample of
documents). A text is tagged in overlapping windows; their scores are blended, the middle of
a window counting more than its edges, and one Viterbi pass over the blended scores decodes each
region as a whole, so no span is cut or counted twice where windows meet. Regions beyond ``STRETCH`` characters
are decoded in stretches that overlap by more than a span; a span belongs to the stretch whose own part it begins in.

No span of the four kinds is valid without a digit or an at sign, so regions lie around those
characters; the rest of a text can't hold a span and isn't tagged. Spans of the tagger are added
where they overlap no base span and hold what their kind asks for (Luhn's check, parts up to 255,
numbers of digits); base spans always stay. Its labels are base spans and variants of them that the patterns
miss (``variants``): phones without a plus sign, with a leading 00, with dots or slashes between the groups or brackets
around the first, cards with dots between the groups, and two spans side by side, which a pattern reads as one.
Regions that no pattern matches even loosely are taught as empty.

Bounded sample: of documents, ``TRAIN_DOCS`` expected, chosen by a hash of the id, and of those
``TRAIN_WINDOWS`` windows per kind, from which ``VARIED`` further ones are made. Everything else covers all documents in a map without shuffle.

Defined results: texts of any length are searched whole, in bounded memory beyond the text; extra columns are ignored; an empty
table gives no rows; null and empty texts have no spans; without any labelled span the tagger is left
out and the base spans remain; repeated rows are treated alike; places are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, map_batches, whole_text

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 40_000
TRAIN_WINDOWS = 400
VARIED = 1600
WINDOW = 64
AROUND = 40
HIDDEN = 20
EMBEDDED = 10
STEPS = 900
BATCH = 32
STRETCH = 2048
SURE = 0.8

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")

# A character's number: printable ASCII each its own; 0 pads.
CHARS = 101


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every at sign decides one match: the longest local part before it, the domain after it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(last, at + 1))


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _ip_ok(found: str) -> bool:
    # Leading zeros are nothing; a part of more digits than any number up to 255 has is above it.
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _card_ok(found: str) -> bool:
    digits = digits_of(found)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(found: str) -> bool:
    return 9 <= len(digits_of(found)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not TRIGGER.search(text):
        return []
    made = [("email", s, e) for s, e in emails(text)]
    for kind, pattern, holds in (("ip", IP, _ip_ok), ("card", CARD, _card_ok), ("phone", PHONE, _phone_ok)):
        made += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m.group())]
    return made


def valid(kind: str, found: str) -> bool:
    """What a span of the tagger must hold to be one of its kind."""
    if kind == "email":
        local, _, domain = found.rpartition("@")
        return bool(local) and bool(DOMAIN.fullmatch(domain)) and not re.search(r"\s", local)
    if kind == "ip":
        return bool(IP.fullmatch(found)) and _ip_ok(found)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9](?:[\x20.-]{0,3}[0-9])+", found)) and _card_ok(found)
    return bool(re.fullmatch(r"[+(]?[0-9][\x20().0-9/-]+[0-9]", found)) and _phone_ok(found)


def numbers_of(text: str) -> np.ndarray:
    """Character numbers: 1 to 95 printable ASCII, 96 other spaces, 97 to 99 other ranges."""
    at = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    made = np.where((at >= 32) & (at < 127), at - 31, 97)
    made[(at == 9) | (at == 10) | (at == 13)] = 96
    made[(at >= 0xC0) & (at < 0x250)] = 98
    made[at >= 0x250] = 99
    return made


class Tagger:
    """BiLSTM-CRF over character numbers. Tags: 0 outside, 1 + 2k the first, 2 + 2k a further
    character of kind k."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @classmethod
    def fresh(cls, rng: np.random.Generator, tags: int = 1 + 2 * len(KINDS)) -> Tagger:
        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        p = {"embed": draw(CHARS, EMBEDDED) * 3, "out": draw(2 * HIDDEN, tags)}
        for way in ("on", "back"):
            p[f"{way}.x"], p[f"{way}.h"] = draw(EMBEDDED, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
            p[f"{way}.b"] = np.zeros(4 * HIDDEN, np.float32)
            p[f"{way}.b"][HIDDEN : 2 * HIDDEN] = 1.0  # gates that forget start open
        p["bias"], p["move"] = np.zeros(tags, np.float32), np.zeros((tags, tags), np.float32)
        return cls(p)

    def _run(self, way: str, x: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each step of x (steps, rows, embedded), and what the way back needs."""
        steps, rows, _ = x.shape
        drive = x @ self.p[f"{way}.x"] + self.p[f"{way}.b"]
        h = c = np.zeros((rows, HIDDEN), np.float32)
        states, tape = np.empty((steps, rows, HIDDEN), np.float32), []
        for t in range(steps):
            z = drive[t] + h @ self.p[f"{way}.h"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            tape.append((h, before, i, f, o, g, squashed))
            h = o * squashed
            states[t] = h
        return states, tape

    def _run_back(self, way: str, x, tape, d_states, grads) -> np.ndarray:
        """Adds to ``grads``; returns the gradient of x."""
        w, d_drive = self.p[f"{way}.h"], np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = 0.0
        for t in range(len(tape) - 1, -1, -1):
            h, before, i, f, o, g, squashed = tape[t]
            dh = d_states[t] + dh
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)],
                axis=1,
            )
            d_drive[t] = dz
            grads[f"{way}.h"] += h.T @ dz
            dh, dc = dz @ w.T, dc * f
        flat = d_drive.reshape(-1, 4 * HIDDEN)
        grads[f"{way}.x"] += x.reshape(-1, EMBEDDED).T @ flat
        grads[f"{way}.b"] += flat.sum(axis=0)
        return d_drive @ self.p[f"{way}.x"].T

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        """(rows, steps, tags) for windows of character numbers (rows, steps)."""
        x = self.p["embed"][numbers.T]
        on, _ = self._run("on", x)
        back, _ = self._run("back", x[::-1])
        both = np.concatenate([on, back[::-1]], axis=2)
        return (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def gradients(self, numbers: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags under the CRF, and its gradients."""
        p, rows = self.p, len(numbers)
        x = p["embed"][numbers.T]
        on, tape_on = self._run("on", x)
        back, tape_back = self._run("back", x[::-1])
        both = np.concatenate([on, back[::-1]], axis=2)
        s = both @ p["out"] + p["bias"]
        loss, ds, dmove = crf_gradients(s, p["move"], tags.T)
        ds, grads = ds / rows, {k: np.zeros_like(v) for k, v in p.items()}
        grads["move"] += dmove / rows
        grads["out"] += both.reshape(-1, 2 * HIDDEN).T @ ds.reshape(-1, ds.shape[2])
        grads["bias"] += ds.sum(axis=(0, 1))
        d_both = ds @ p["out"].T
        dx = self._run_back("on", x, tape_on, d_both[:, :, :HIDDEN], grads)
        dx += self._run_back("back", x[::-1], tape_back, d_both[::-1, :, HIDDEN:], grads)[::-1]
        np.add.at(grads["embed"], numbers.T, dx)
        return loss / rows, grads

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tags (rows, steps) by Viterbi's algorithm."""
        rows, steps, tags = scores.shape
        best, came = scores[:, 0], np.empty((steps, rows, tags), np.int8)
        for t in range(1, steps):
            ways = best[:, :, None] + self.p["move"]
            came[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[:, t]
        made = np.empty((rows, steps), np.int64)
        made[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            made[:, t - 1] = came[t][np.arange(rows), made[:, t]]
        return made


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradients(s: np.ndarray, move: np.ndarray, tags: np.ndarray):
    """Summed loss and its gradients in the scores s (steps, rows, tags) and the moves."""
    steps, rows, _ = s.shape
    ahead, behind = np.empty_like(s), np.zeros_like(s)
    ahead[0] = s[0]
    for t in range(1, steps):
        ahead[t] = _log_sum(ahead[t - 1][:, :, None] + move, axis=1) + s[t]
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(move[None] + (s[t + 1] + behind[t + 1])[:, None, :], axis=2)
    whole = _log_sum(ahead[-1], axis=1)
    ds = np.exp(ahead + behind - whole[None, :, None])
    dmove = np.zeros_like(move)
    for t in range(1, steps):
        pair = ahead[t - 1][:, :, None] + move + (s[t] + behind[t])[:, None, :] - whole[:, None, None]
        dmove += np.exp(pair).sum(axis=0)
    t, r = np.meshgrid(np.arange(steps), np.arange(rows), indexing="ij")
    gold = s[t, r, tags].sum() + move[tags[:-1], tags[1:]].sum()
    ds[t, r, tags] -= 1
    np.add.at(dmove, (tags[:-1], tags[1:]), -1)
    return float(whole.sum() - gold), ds, dmove


def train(windows: list[str], tags: list[list[int]], steps: int | None = None, seed: int = 5) -> Tagger:
    """Fit on windows of at most WINDOW characters and their tags, by Adam."""
    rng, steps = np.random.default_rng(seed), steps or STEPS
    x, y = np.zeros((len(windows), WINDOW), np.int64), np.zeros((len(windows), WINDOW), np.int64)
    for i, (w, t) in enumerate(zip(windows, tags)):
        x[i, : len(w)], y[i, : len(t)] = numbers_of(w), t
    tagger = Tagger.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), BATCH)
        _, grads = tagger.gradients(x[rows], y[rows])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g**2
            move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            tagger.p[k] = (tagger.p[k] - rate * move).astype(np.float32)
    return tagger


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within AROUND characters of a digit or an at sign, merged."""
    made: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        start, end = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if made and start <= made[-1][1]:
            made[-1][1] = end
        else:
            made.append([start, end])
    return [(s, e) for s, e in made]


def stretches(start: int, end: int) -> list[tuple[int, int, int, int]]:
    """(start, end, own start, own end) of the parts in which a region is decoded."""
    firsts = range(start, end, STRETCH)
    return [(max(start, f - WINDOW), min(end, f + STRETCH + 2 * WINDOW), f, min(end, f + STRETCH)) for f in firsts]


def _looks_like(part: str) -> bool:
    """True if a pattern matches before its check."""
    cards = (len(digits_of(m.group())) >= 9 for m in CARD.finditer(part))
    return bool(IP.search(part) or PHONE.search(part)) or any(cards)


def labelled_windows(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, list[int]]]:
    """(kind, window, tags): one around every span, and one around every region without a span."""
    tags = np.zeros(len(text), np.int64)
    for kind, start, end in spans:
        k = KINDS.index(kind)
        tags[start:end] = 2 + 2 * k
        tags[start] = 1 + 2 * k
    places = [(kind, start, end) for kind, start, end in spans if end - start < WINDOW]
    starts = sorted((s, e) for _, s, e in spans)
    for start, end in regions(text):
        # What looks like a span but fails its check would only teach doubt.
        if not any(s < end and e > start for s, e in starts) and not _looks_like(text[start:end]):
            middle = (start + end) // 2
            places.append(("none", middle, middle + 1))
    made = []
    for kind, start, end in places:
        # Where the span lies in its window varies, but is the same on every run.
        room = WINDOW - (end - start)
        at = max(0, start - (start * 7 + end * 13) % (room + 1))
        made.append((kind, text[at : at + WINDOW], tags[at : at + WINDOW].tolist()))
    return made


def variants(kind: str, found: str) -> list[str]:
    """Spellings of a base span that the patterns miss or read otherwise; empty for mails and addresses."""
    groups = re.findall(r"[0-9]+", found)
    if kind == "phone":
        bare = found[1:]
        return [
            bare,
            "00" + bare,
            ".".join(groups),
            "/".join((groups[0], "".join(groups[1:]))) if len(groups) > 1 else bare,
            f"({groups[0]}) " + "-".join(groups[1:]) if len(groups) > 1 else bare,
            " ".join(groups),
        ]
    if kind == "card":
        digits = digits_of(found)
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), ". ".join(fours), " - ".join(fours)[: WINDOW // 2 + 8]] if len(fours[-1]) == 4 else []
    return []


def varied_windows(rows: list[tuple[str, str, list[int]]], seed: int = 6) -> list[tuple[str, list[int]]]:
    """VARIED windows (text, tags) made from ``rows`` (kind, window, tags).

    In place of a window's base span stands a variant, the span itself, or two spans side by side. Digits are drawn
    anew (but for addresses, whose parts have a bound), so that what is learned is the spelling, not the numbers of the sample.
    """
    rng = np.random.default_rng(seed)
    spans = [(kind, cut, *own[1:]) for kind, cut, tags in rows for own in _runs(np.array(tags)) if own[0] == kind]
    spans = [s for s in spans if s[3] - s[2] < WINDOW - 4]

    def drawn(kind: str, found: str) -> str:
        return found if kind in ("email", "ip") else re.sub("[0-9]", lambda _: str(rng.integers(10)), found)

    made = []
    while spans and len(made) < VARIED:
        kind, cut, start, end = spans[int(rng.integers(len(spans)))]
        found = drawn(kind, cut[start:end])
        others = variants(kind, found) or [found]
        pair = [(kind, others[int(rng.integers(len(others)))])]
        if rng.random() < 0.3:
            other_kind, other_cut, s, e = spans[int(rng.integers(len(spans)))]
            pair = [(kind, found), (other_kind, drawn(other_kind, other_cut[s:e]))]
            if rng.random() < 0.5:
                pair[1] = (kind, drawn(kind, found))
        if sum(len(x) for _, x in pair) < WINDOW - 4:
            made.append(_rewritten(cut, start, end, pair, int(rng.integers(WINDOW))))
    return made


def _rewritten(cut: str, start: int, end: int, spans: list[tuple[str, str]], shift: int) -> tuple[str, list[int]]:
    """The window with its span replaced, of WINDOW characters around what is new, and its tags."""
    text, tags = cut[:start], [0] * start
    for nth, (kind, own) in enumerate(spans):
        text, tags = text + " " * (nth > 0), tags + [0] * (nth > 0)
        k = KINDS.index(kind)
        text, tags = text + own, tags + [1 + 2 * k] + [2 + 2 * k] * (len(own) - 1)
    width = len(text) - start
    text, tags = text + cut[end:], tags + [0] * (len(cut) - end)
    at = max(0, min(start, start + width - WINDOW + shift % max(1, WINDOW - width)))
    return text[at : at + WINDOW], tags[at : at + WINDOW]


def learn(docs: DataFrame) -> Tagger | None:
    """A tagger from the base spans in a sample of ``docs`` (doc_id, text) and their variants; None without any."""
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("tagger")), 11) / float(2**53)
    n = docs.count()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [
            (own, i, *w)
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for i, w in enumerate(labelled_windows(text, base_spans(text)))
        ]
        columns = list(zip(*made)) or [()] * 5
        types = [pa.float64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["place", "nth", "kind", "cut", "tags"],
        )

    chosen = docs.select(share.alias("place"), whole_text().alias("text")).where(
        (F.col("place") < min(1.0, TRAIN_DOCS / max(n, 1))) & F.col("text").rlike("[0-9@]")
    )
    windows = map_batches(chosen, cut, "place double, nth long, kind string, cut string, tags array<long>")
    order = Window.partitionBy("kind").orderBy("nth", "place", "cut")
    few = windows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TRAIN_WINDOWS)
    rows = few.orderBy("kind", "rank").select("kind", "cut", "tags").collect()
    if not any(r.kind != "none" for r in rows):
        return None
    varied = varied_windows([(r.kind, r.cut, r.tags) for r in rows])
    return train([*(r.cut for r in rows), *(w for w, _ in varied)], [*(r.tags for r in rows), *(t for _, t in varied)])


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans of the tagger in every text, before they meet the base spans."""
    places = [(i, *stretch) for i, text in enumerate(texts) for s, e in regions(text) for stretch in stretches(s, e)]
    made: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    # Regions of like length are padded together, a bounded number of characters at once.
    places.sort(key=lambda p: p[2] - p[1])
    at = 0
    while at < len(places):
        end, widest = at, 0
        while end < len(places) and (end - at + 1) * (widest := places[end][2] - places[end][1]) <= 200_000:
            end += 1
        part = places[at : max(end, at + 1)]
        at += len(part)
        blended, lengths = _blended(tagger, [texts[i][s:e] for i, s, e, _, _ in part])
        tags = tagger.decode(blended)
        odds = np.exp(blended - blended.max(axis=2, keepdims=True))
        sure = odds.max(axis=2) / odds.sum(axis=2)
        for (i, start, _, first, last), row, sureness, n in zip(part, tags, sure, lengths):
            for kind, s, e in _runs(row[:n]):
                if first <= start + s < last and sureness[s:e].mean() >= SURE:
                    made[i].append((kind, start + s, start + e))
    return made


def _blended(tagger: Tagger, parts: list[str]) -> tuple[np.ndarray, list[int]]:
    """Scores (regions, characters, tags), windows blended by a triangle of weights."""
    lengths, step = [len(p) for p in parts], WINDOW // 2
    longest = max(lengths)
    tags = len(tagger.p["bias"])
    total = np.zeros((len(parts), longest + WINDOW, tags), np.float32)
    weights = np.zeros((len(parts), longest + WINDOW), np.float32)
    padded = np.zeros((len(parts), longest + WINDOW), np.int64)
    for i, p in enumerate(parts):
        padded[i, : len(p)] = numbers_of(p)
    shape = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)
    for start in range(0, max(longest - step, 1), step):
        here = [i for i, n in enumerate(lengths) if n > start]
        for a in range(0, len(here), 1024):
            own = np.array(here[a : a + 1024])
            scores = tagger.scores(padded[own, start : start + WINDOW])
            total[own, start : start + WINDOW] += scores * shape[None, :, None]
            weights[own, start : start + WINDOW] += shape
    made = total[:, :longest] / np.maximum(weights[:, :longest], 1e-6)[:, :, None]
    outside = np.arange(longest)[None, :] >= np.array(lengths)[:, None]
    made[outside] = np.where(np.arange(tags) == 0, 0.0, -1e4)
    return made, lengths


def _runs(tags: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Spans from tags: a first character, then further ones of its kind."""
    inside = np.flatnonzero(tags)
    at = 0
    while at < len(inside):
        start = end = inside[at]
        kind = (tags[start] - 1) // 2
        while at + 1 < len(inside) and inside[at + 1] == end + 1 and tags[end + 1] == 2 + 2 * kind:
            at, end = at + 1, end + 1
        at += 1
        yield KINDS[kind], int(start), int(end) + 1


def all_spans(
    text: str, base: list[tuple[str, int, int]], tagged: list[tuple[str, int, int]]
) -> list[tuple[str, int, int]]:
    """Base spans and the valid ones of the tagger that overlap none, nor one another."""
    made, taken = list(base), sorted((s, e) for _, s, e in base)
    busy = np.zeros(len(text) + 1, bool)
    for s, e in taken:
        busy[s:e] = True
    for kind, start, end in sorted(tagged, key=lambda t: (t[1], t[2])):
        while start < end and text[start].isspace():
            start += 1
        while end > start and (text[end - 1].isspace() or text[end - 1] in ".,;:"):
            end -= 1
        if start < end and not busy[start:end].any() and valid(kind, text[start:end]):
            busy[start:end] = True
            made.append((kind, start, end))
    return sorted(made, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, spans
    (all of them); without a tagger one is learned from ``docs``."""
    tagger = tagger or learn(docs)
    sent = docs.sparkSession.sparkContext.broadcast(tagger and tagger.p)

    def find_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = sent.value and Tagger(sent.value)
        texts = batch.column(1).to_pylist()
        base = [base_spans(t) for t in texts]
        asked = [i for i, t in enumerate(texts) if TRIGGER.search(t)] if own else []
        spans = list(base)
        for i, tagged in zip(asked, tagged_spans(own, [texts[i] for i in asked]) if asked else []):
            if tagged:
                spans[i] = all_spans(texts[i], base[i], tagged)
        counts = [
            pa.array([sum(k == kind for k, _, _ in b) for b in base], pa.int64()) for kind in KINDS
        ]
        digests = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array(map(joined, spans), pa.string())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_batches(docs.select("doc_id", whole_text().alias("text")), find_batch, schema)


by_value(__name__)
