"""Personal data: spans by pattern, and by a character BiLSTM with CRF transitions."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Without one of these a text has no span, neither by pattern nor by the model.
TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in string.digits)


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@`` and a dotted domain, in linear time: each
    ``@`` has at most one, whose local part reaches back as far as it can."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[Span]:
    """Four dotted numbers up to 255. Matches of a longer chain follow one another."""
    for chain in CHAIN.finditer(text):
        whole, at = chain.group(), chain.start()
        parts = [m.span() for m in re.finditer("[0-9]+", whole)] if "." in whole else []
        for i in range(0, len(parts) - 3, 4):
            values = [whole[a:b].lstrip("0") for a, b in parts[i : i + 4]]
            if all(len(v) < 4 and int(v or 0) <= 255 for v in values):
                yield "ip", at + parts[i][0], at + parts[i + 3][1]


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        # A run of digits that is far too long is none; it need not be copied.
        if m.end() - m.start() < 38:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", m.start(), m.end()


def base_spans(text: str | None) -> list[Span]:
    """Spans (kind, start, end; code points) that the patterns find, by kind, then place."""
    if not text or not TRIGGER.search(text):
        return []
    return [*emails(text), *addresses(text), *cards(text), *phones(text)]


def spelled(spans: Sequence[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


# --- the model -------------------------------------------------------------------------

#: Tags: outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Printable ASCII has a code per character; other letters, white space and the rest one each.
CODES = 95 + 4
#: Characters of a window, and how far windows lie apart.
WINDOW, STRIDE = 96, 48


def char_codes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    space = (raw == 9) | (raw == 10) | (raw == 13) | (raw == 0xA0) | ((raw >= 0x2000) & (raw <= 0x200A)) | (raw == 0x3000)
    other = np.where(space, 96, np.where(raw < 32, 97, np.where(raw < 0x2000, 95, 98)))
    return np.where((raw >= 32) & (raw < 127), raw - 32, other).astype(np.int16)


def legal() -> np.ndarray:
    """Which tag may follow which (row before column); inside needs its own kind before."""
    ok = np.ones((TAGS, TAGS), bool)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        ok[:, inside] = False
        ok[[inside - 1, inside], inside] = True
    return ok


LEGAL = legal()
START = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])
NEVER = -1e9


def tags_of(size: int, spans: Sequence[Span]) -> np.ndarray:
    tags = np.zeros(size, np.int64)
    for kind, a, b in spans:
        first = 1 + 2 * KINDS.index(kind)
        if 0 <= a and b <= size and not tags[a:b].any():
            tags[a:b] = first + 1
            tags[a] = first
    return tags


def spans_of(tags: np.ndarray) -> list[Span]:
    found = []
    for a in np.flatnonzero(tags % 2 == 1).tolist():
        b = a + 1
        while b < len(tags) and tags[b] == tags[a] + 1:
            b += 1
        found.append((KINDS[tags[a] // 2], a, b))
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Bidirectional LSTM over character codes, tag scores, and CRF transitions.

    ``params``: ``embed``; per direction ``wx``, ``wh``, ``b`` (gates in, forget, out,
    candidate); ``out``, ``bias``; ``trans``.
    """

    params: dict[str, np.ndarray]

    @classmethod
    def new(cls, width: int = 12, hidden: int = 20, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        params = {"embed": draw(CODES, width) * 3, "out": draw(2 * hidden, TAGS), "bias": np.zeros(TAGS, np.float32)}
        for way in ("f", "b"):
            params |= {f"wx{way}": draw(width, 4 * hidden), f"wh{way}": draw(hidden, 4 * hidden)}
            params[f"b{way}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)
        return cls(params | {"trans": np.zeros((TAGS, TAGS), np.float32)})

    def _lstm(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states of (time, row, width) inputs; what the way back needs if ``keep``."""
        wh = self.params["wh" + way]
        n = wh.shape[0]
        gates = x @ self.params["wx" + way] + self.params["b" + way]
        h, c = np.zeros((x.shape[1], n), x.dtype), np.zeros((x.shape[1], n), x.dtype)
        states, held = np.empty((len(x), x.shape[1], n), x.dtype), []
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            z = gates[t] + h @ wh
            g = _sigmoid(z[:, : 3 * n])
            new = np.tanh(z[:, 3 * n :])
            before = h, c
            c = g[:, n : 2 * n] * c + g[:, :n] * new
            top = np.tanh(c)
            h = g[:, 2 * n :] * top
            states[t] = h
            if keep:
                held.append((t, g, new, top, *before))
        return states, held

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Tag scores (time, row, tag) of windows (row, time) of codes."""
        x = self.params["embed"][codes.T]
        both = np.concatenate([self._lstm(x, way, False)[0] for way in "fb"], axis=2)
        return both @ self.params["out"] + self.params["bias"]

    def loss_and_slopes(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood a character of the windows' tags, and its gradient."""
        p = self.params
        x = p["embed"][codes.T]
        sides = {way: self._lstm(x, way, True) for way in "fb"}
        both = np.concatenate([sides["f"][0], sides["b"][0]], axis=2)
        scores = both @ p["out"] + p["bias"]
        loss, d_scores, d_trans = crf_slopes(scores, p["trans"], tags.T)
        slopes = {k: np.zeros_like(v) for k, v in p.items()}
        slopes["trans"] += d_trans
        flat = d_scores.reshape(-1, TAGS)
        slopes["out"] += both.reshape(len(flat), -1).T @ flat
        slopes["bias"] += flat.sum(axis=0)
        d_both = d_scores @ p["out"].T
        n = p["whf"].shape[0]
        d_x = np.zeros_like(x)
        for way, d_states in (("f", d_both[:, :, :n]), ("b", d_both[:, :, n:])):
            wh, wx = p["wh" + way], p["wx" + way]
            dh, dc = np.zeros_like(d_states[0]), np.zeros_like(d_states[0])
            for t, g, new, top, h, c in reversed(sides[way][1]):
                dh = dh + d_states[t]
                dc = dc + dh * g[:, 2 * n :] * (1 - top**2)
                d_gate = np.concatenate([dc * new, dc * c, dh * top], axis=1) * g * (1 - g)
                dz = np.concatenate([d_gate, dc * g[:, :n] * (1 - new**2)], axis=1)
                slopes["wh" + way] += h.T @ dz
                slopes["wx" + way] += x[t].T @ dz
                slopes["b" + way] += dz.sum(axis=0)
                d_x[t] += dz @ wx.T
                dh, dc = dz @ wh.T, dc * g[:, n : 2 * n]
        np.add.at(slopes["embed"], codes.T, d_x)
        return loss, slopes


def _summed_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def crf_slopes(scores: np.ndarray, trans: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss of ``tags`` (time, row) and gradients of scores and transitions.

    Forward and backward sums run over legal paths only.
    """
    steps, rows, _ = scores.shape
    moves = np.where(LEGAL, trans, NEVER)
    ahead = np.empty_like(scores, np.float64)
    ahead[0] = np.where(START, scores[0], NEVER)
    for t in range(1, steps):
        ahead[t] = _summed_exp(ahead[t - 1][:, :, None] + moves, 1) + scores[t]
    whole = _summed_exp(ahead[-1], 1)
    behind = np.zeros((rows, TAGS))
    share = np.empty_like(ahead)
    share[-1] = np.exp(ahead[-1] - whole[:, None])
    d_trans = np.zeros((TAGS, TAGS))
    for t in range(steps - 1, 0, -1):
        onward = moves + (scores[t] + behind)[:, None, :]
        pair = np.exp(ahead[t - 1][:, :, None] + onward - whole[:, None, None])
        d_trans += pair.sum(axis=0)
        share[t - 1] = pair.sum(axis=2)
        behind = _summed_exp(onward, 2)
    time, row = np.indices(tags.shape)
    right = scores[time, row, tags].sum() + moves[tags[:-1], tags[1:]].sum()
    share[time, row, tags] -= 1
    np.add.at(d_trans, (tags[:-1], tags[1:]), -1)
    n = steps * rows
    return float(whole.sum() - right) / n, (share / n).astype(scores.dtype), np.where(LEGAL, d_trans / n, 0).astype(trans.dtype)


def viterbi(scores: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best legal tags (time, row) of runs of different lengths, padded behind with 0."""
    steps, rows, _ = scores.shape
    moves = np.where(LEGAL, trans, NEVER)
    best = np.where(START, scores[0], NEVER)
    came = np.zeros((steps, rows, TAGS), np.int8)
    last = best.copy()
    for t in range(1, steps):
        total = best[:, :, None] + moves
        came[t] = total.argmax(axis=1)
        best = total.max(axis=1) + scores[t]
        ending = lengths == t + 1
        last[ending] = best[ending]
    out = np.zeros((steps, rows), np.int64)
    tag = last.argmax(axis=1)
    every = np.arange(rows)
    for t in range(steps - 1, -1, -1):
        here = lengths > t
        out[t, here] = tag[here]
        if t:
            tag = np.where(here, came[t, every, tag], tag)
    return out


def fit(windows: Sequence[tuple[str, Sequence[Span]]], *, rounds: int = 12, batch: int = 96, rate: float = 0.02, seed: int = 5) -> Tagger:
    """Learn tags of labelled windows (text, spans) with Adam; the rate falls to nothing.

    Texts are cut or padded (with line ends, tagged outside) to ``WINDOW`` characters.
    """
    rng = np.random.default_rng(seed)
    codes = np.full((len(windows), WINDOW), 96, np.int16)
    tags = np.zeros((len(windows), WINDOW), np.int64)
    for row, (text, spans) in enumerate(windows):
        own = char_codes(text[:WINDOW])
        codes[row, : len(own)] = own
        tags[row, : len(own)] = tags_of(len(own), [s for s in spans if s[2] <= WINDOW])
    tagger = Tagger.new()
    first = {k: np.zeros_like(v) for k, v in tagger.params.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.params.items()}
    total, step = rounds * -(-len(windows) // batch), 0
    for _ in range(rounds):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            _, slopes = tagger.loss_and_slopes(codes[some], tags[some])
            size = np.sqrt(sum(float((g**2).sum()) for g in slopes.values()))
            step += 1
            for k, g in slopes.items():
                g = g * min(1.0, 1.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                tagger.params[k] = tagger.params[k] - (rate * (1 - step / (total + 1)) * move).astype(np.float32)
    return tagger


# --- windows over whole texts ----------------------------------------------------------

#: Windows run together, and characters decoded together.
TOGETHER, DECODED = 512, 200_000
BLEND = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text that windows with a digit or ``@`` cover, cut at line ends.

    A span holds such a character and no line end, so no tag but outside is possible
    elsewhere, and the parts decode as the whole text would.
    """
    found: list[list[int]] = []
    for m in re.finditer(r"[^\n]+", text):
        a, b = m.span()
        for hit in re.finditer(r"[0-9@]+", m.group()):
            start = max(a, a + hit.start() - STRIDE)
            end = min(b, a + hit.end() + STRIDE)
            if found and found[-1][0] >= a and start <= found[-1][1]:
                found[-1][1] = end
            else:
                found.append([start, end])
    return [(a, b) for a, b in found]


def model_spans(tagger: Tagger, texts: Sequence[str]) -> Iterator[list[Span]]:
    """Spans the model sees in each text.

    Every stretch is covered by windows that overlap by half. Scores of a character that
    several windows cover are blended, the window in whose middle it lies weighing most,
    and one Viterbi pass over the whole stretch settles all its spans at once.
    """
    parts = [(i, a, b) for i, text in enumerate(texts) for a, b in stretches(text)]
    found: dict[int, list[Span]] = {}
    group: list[tuple[int, int, int]] = []
    size = 0
    for part in sorted(parts, key=lambda p: p[2] - p[1]):
        if group and size + part[2] - part[1] > DECODED:
            _decode(tagger, texts, group, found)
            group, size = [], 0
        group.append(part)
        size += part[2] - part[1]
    if group:
        _decode(tagger, texts, group, found)
    return (sorted(found.get(i, ())) for i in range(len(texts)))


def _decode(tagger: Tagger, texts: Sequence[str], parts: list[tuple[int, int, int]], found: dict[int, list[Span]]) -> None:
    codes = [char_codes(texts[i][a:b]) for i, a, b in parts]
    lengths = np.array(list(map(len, codes)))
    places = [(p, s) for p, n in enumerate(lengths.tolist()) for s in range(0, max(1, n - STRIDE), STRIDE)]
    scores = [np.zeros((n, TAGS), np.float32) for n in lengths.tolist()]
    weights = [np.zeros((n, 1), np.float32) for n in lengths.tolist()]
    for at in range(0, len(places), TOGETHER):
        some = places[at : at + TOGETHER]
        held = np.full((len(some), WINDOW), 96, np.int16)
        for row, (p, s) in enumerate(some):
            own = codes[p][s : s + WINDOW]
            held[row, : len(own)] = own
        got = tagger.emissions(held)
        for row, (p, s) in enumerate(some):
            n = min(WINDOW, len(codes[p]) - s)
            scores[p][s : s + n] += got[:n, row] * BLEND[:n, None]
            weights[p][s : s + n] += BLEND[:n, None]
    # Runs of like lengths decode together, so little of a block is padding.
    start = 0
    while start < len(parts):
        stop = start + 1
        while stop < len(parts) and lengths[stop] * (stop + 1 - start) <= max(DECODED // 4, lengths[stop]):
            stop += 1
        longest = int(lengths[start:stop].max())
        block = np.zeros((longest, stop - start, TAGS), np.float32)
        for row in range(start, stop):
            block[: lengths[row], row - start] = scores[row] / weights[row]
        tags = viterbi(block, tagger.params["trans"], lengths[start:stop])
        for row in range(start, stop):
            i, a, _ = parts[row]
            found.setdefault(i, []).extend((k, a + x, a + y) for k, x, y in spans_of(tags[: lengths[row], row - start]))
        start = stop


def holds(kind: str, text: str) -> bool:
    """Whether what the model took for a span can be one: the kinds' own checks."""
    digits = _digits(text)
    if kind == "email":
        local, _, domain = text.partition("@")
        return bool(local) and "." in domain.strip(".") and not re.search(r"[\s@]", local + domain)
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and re.fullmatch(r"[0-9]+(?:[^0-9A-Za-z]{1,3}[0-9]+){3}", text) is not None and all(len(p) < 4 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9](?:[^0-9A-Za-z]{0,2}[0-9])+", text) is not None
    return 9 <= len(digits) <= 15 and re.fullmatch(r"\+?\(?[0-9](?:[^0-9A-Za-z\n]{0,3}[0-9])+", text) is not None and len(text) > len(digits)


def with_added(text: str, base: Sequence[Span], more: Sequence[Span]) -> list[Span]:
    """Base spans, and the model's that pass the checks and touch none before them."""
    kept = list(base)
    for kind, a, b in more:
        if holds(kind, text[a:b]) and all(b <= x or y <= a for _, x, y in kept):
            kept.append((kind, a, b))
    return kept


# --- over tables -----------------------------------------------------------------------

#: Labelled windows the model learns from: so many of each kind, and of none.
PER_KIND, PLAIN = 500, 1_500
ADDED = "spans string, base_spans string, n_email long, n_ip long, n_card long, n_phone long"


def varied(kind: str, text: str, rng: np.random.Generator) -> str:
    """The span in another spelling that people use and the patterns miss, half of the time."""
    if rng.random() < 0.5:
        return text
    if kind == "phone":
        text = text if rng.random() < 0.5 else text.lstrip("+")
        sign = "-./ "[rng.integers(4)]
        return re.sub(r"(?<=[0-9)])[ -](?=[0-9])", sign, text)
    if kind == "card":
        digits, sign = _digits(text), ".- /"[rng.integers(4)]
        return sign.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == "ip":
        return text.replace(".", (" . ", "[.]", ".")[rng.integers(3)])
    local, _, domain = text.partition("@")
    return f"{local}@{domain.upper() if rng.random() < 0.5 else domain}"


def labelled_windows(texts: DataFrame) -> DataFrame:
    """Windows around the patterns' spans, and around digits that are in none.

    (``kind``: '' without a span, ``h``: a hash that orders them, ``text``, ``spans``.)
    One window per span; of a text without spans at most four, by hash.
    """

    def cut(text: str, spans: list[Span], centre: int, shift: int) -> tuple[str, str]:
        a = max(0, min(centre - shift, len(text) - WINDOW))
        b = min(len(text), a + WINDOW)
        inside = [(k, x - a, y - a) for k, x, y in spans if a <= x and y <= b]
        return text[a:b], spelled(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                taken = [(k, a) for k, a, _ in spans]
                if text and not spans:
                    hits = ((xxhash.xxh64_intdigest(f"{m.start()}", 7), m.start()) for m in re.finditer("[0-9@]+", text))
                    taken = [("", a) for _, a in sorted(hits)[:4]]
                for kind, at in taken:
                    h = xxhash.xxh64_intdigest(text[max(0, at - 100) : at + 100].encode("utf-8", "replace"), 11)
                    rows.append((kind, h >> 1, *cut(text, spans, at, 20 + h % 40)))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            types = (pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["kind", "h", "text", "spans"])

    return texts.mapInArrow(run, "kind string, h long, text string, spans string")


def read_spans(text: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in text.split(",") if s)]


def train(texts: DataFrame, *, per_kind: int = PER_KIND, plain: int = PLAIN, seed: int = 9) -> Tagger | None:
    """A tagger for the column ``texts``, from the patterns' spans as labels.

    It learns from at most ``per_kind`` windows of each kind and ``plain`` without a span:
    those of least hash, so the choice does not depend on partitions. Spans are respelled
    half of the time, so that the model finds what the patterns cannot; numbers that fail
    the patterns' checks are its counterexamples. None where there is no span to learn.
    """
    pool = staged(labelled_windows(texts).distinct(), "private-windows")
    rng = np.random.default_rng(seed)
    windows = []
    for kind in (*KINDS, ""):
        some = pool.where(F.col("kind") == kind).orderBy("h", "text").limit(per_kind if kind else plain)
        windows += [_respelled(r["text"], read_spans(r["spans"]), rng) for r in some.collect()]
    if not any(spans for _, spans in windows):
        return None
    windows += [_foreign(text, rng) for text, _ in windows[: len(windows) // 3]]
    return fit(windows)


def _respelled(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    out, moved, at = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        out += text[at:a]
        new = varied(kind, text[a:b], rng)
        moved.append((kind, len(out), len(out) + len(new)))
        out, at = out + new, b
    return out + text[at:], moved


def _foreign(text: str, rng: np.random.Generator) -> tuple[str, list[Span]]:
    """A window whose digits and signs are those of dates, versions, amounts and numbers."""
    words = re.sub(r"\S*[0-9@]\S*", "", text)[: WINDOW - 24]
    n = lambda k: "".join(str(rng.integers(10)) for _ in range(k))
    forms = (f"20{n(2)}-0{n(1)}-1{n(1)}", f"{n(1)}.{n(2)}.{n(1)}", f"{n(3)},{n(3)}.{n(2)}", n(rng.integers(1, 24)), f"{n(2)}:{n(2)}", f"@{words[:4].strip()}", f"{n(4)}-{n(4)}", f"v{n(1)}.{n(1)}")
    at = int(rng.integers(0, len(words) + 1))
    return f"{words[:at]} {forms[rng.integers(len(forms))]} {words[at:]}", []


def private_spans(docs: DataFrame, tagger: Tagger | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text: (``id_col``, ``spans``, ``base_spans``, counts).

    Spans are ``kind:start:end`` in code points, end exclusive, by kind (email, ip, card,
    phone) and start, comma-joined. ``base_spans`` are those of the patterns and ``n_...``
    their numbers; ``spans`` has the model's as well, where they pass their kind's checks
    and overlap none of the patterns'. Null and empty texts have none. Rows with null or
    repeated ids stay rows of their own. Time and memory are in proportion to a text's
    length, also where all of it is digits or one word.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            every = list(base)
            some = [i for i, t in enumerate(texts) if t and TRIGGER.search(t)]
            if tagger is not None:
                for i, more in zip(some, model_spans(tagger, [texts[i] for i in some]), strict=True):
                    every[i] = with_added(texts[i], base[i], more)
            counts = [[sum(k == s[0] for s in b) for b in base] for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(spelled, every), pa.string()),
                    pa.array(map(spelled, base), pa.string()),
                    *(pa.array(c, pa.int64()) for c in counts),
                ],
                names=["id", "spans", "base_spans", "n_email", "n_ip", "n_card", "n_phone"],
            )

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"id {kind}, {ADDED}").withColumnRenamed("id", id_col)
