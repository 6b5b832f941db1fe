"""Personal data: fixed patterns, and a character tagger that adds what they miss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, hash_sample, staged

#: Kinds of the fixed patterns, and all kinds: only the tagger finds secrets, such as access tokens.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
Span = tuple[str, int, int]
# Characters of the base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
#: What may be the same data in another form: such windows have no sure labels.
_UNSURE = re.compile(r"@|[0-9](?:[ ().+/-]*[0-9]){9,}|(?=[a-zA-Z_-]*[0-9])(?=[0-9_-]*[a-zA-Z])[0-9a-zA-Z_-]{16,}")
#: Labels of secrets for training: a quoted run of letters and digits that something is set to.
_QUOTED = re.compile(r"""[=:]\s?["']((?=[a-zA-Z]*[0-9])(?=[0-9]*[a-zA-Z])[0-9a-zA-Z]{20,80})["']""")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches by way of their at-signs, so that long runs cost their length once."""
    done, at = 0, text.find("@")
    while at >= 0:
        if m := _DOMAIN.match(text, at):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then by kind as listed."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if _octets(m[0]):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_only_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# The tagger. Tags: 0 is outside; 1 + 2k begins kind k, 2 + 2k goes on with it.
TAGS = 1 + 2 * len(KINDS)
HIDDEN, WIDTH = 16, 96
STRIDE = WIDTH // 2
#: Windows that the tagger is trained on, about, and passes over them.
SAMPLE, EPOCHS, BATCH, RATE = 2000, 8, 50, 0.03
_MARKS = "@.-_+()/:,='\"%#|*\n \t"
CLASSES = 8 + len(_MARKS)


def _class_table() -> np.ndarray:
    table = np.full(128, 5, np.int64)
    table[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 1
    table[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
    table[[ord(c) for c in "0123456789"]] = 3
    table[[ord(c) for c in "abcdef"]], table[[ord(c) for c in "ABCDEF"]] = 6, 7
    table[[ord(c) for c in _MARKS]] = np.arange(8, CLASSES)
    return table


_ASCII = _class_table()


def classes(text: str) -> np.ndarray:
    """Classes of characters; 0 stands for places outside the text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code < 128, _ASCII[np.minimum(code, 127)], 4)


@dataclass
class Tagger:
    """Bidirectional LSTM over character classes with a CRF over tags."""

    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN)).astype(np.float32)
            p[f"x{d}"][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
            p[f"h{d}"] = rng.normal(0, 0.25, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        p["out"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS)).astype(np.float32)
        p["bias"] = np.zeros(TAGS, np.float32)
        p["bias"][0] = 2
        p["next"] = np.zeros((TAGS, TAGS), np.float32)
        return cls(p)

    @staticmethod
    def allowed() -> np.ndarray:
        """-inf where one tag cannot follow another: a kind goes on only from its own tags."""
        ok = np.zeros((TAGS, TAGS), np.float32)
        for k in range(len(KINDS)):
            ok[:, 2 + 2 * k] = -1e4
            ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
        return ok

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (batch, place, HIDDEN) in one direction, with what the gradient needs."""
        n, width = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, past = np.empty((n, width, HIDDEN), np.float32), []
        for t in range(width) if d == "f" else range(width - 1, -1, -1):
            z = self.p[f"x{d}"][x[:, t]] + h @ self.p[f"h{d}"]
            g = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o, u = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            c2 = f * c + i * u
            tc = np.tanh(c2)
            if keep:
                past.append((t, h, c, i, f, o, u, tc))
            h, c = o * tc, c2
            out[:, t] = h
        return out, past

    def emissions(self, x: np.ndarray, keep: bool = False):
        a, pa_ = self._run(x, "f", keep)
        b, pb = self._run(x, "b", keep)
        h = np.concatenate([a, b], 2)
        return h @ self.p["out"] + self.p["bias"], h, {"f": pa_, "b": pb}

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of tags at each place of each window (batch, place, TAGS)."""
        e = self.emissions(x)[0]
        e = np.exp(e - e.max(2, keepdims=True))
        step = np.exp(self.p["next"] + self.allowed())
        ahead, behind = np.empty_like(e), np.ones_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, x.shape[1]):
            a = (ahead[:, t - 1] @ step) * e[:, t]
            ahead[:, t] = a / a.sum(1, keepdims=True)
        for t in range(x.shape[1] - 2, -1, -1):
            b = (behind[:, t + 1] * e[:, t + 1]) @ step.T
            behind[:, t] = b / b.sum(1, keepdims=True)
        both = ahead * behind
        return both / both.sum(2, keepdims=True)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood of the tags, for each window, and its gradient."""
        n, width = x.shape
        e, h, past = self.emissions(x, True)
        step = self.p["next"] + self.allowed()

        def lse(v, axis):
            m = v.max(axis, keepdims=True)
            return (m + np.log(np.exp(v - m).sum(axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            alpha[:, t] = lse(alpha[:, t - 1, :, None] + step, 1) + e[:, t]
        for t in range(width - 2, -1, -1):
            beta[:, t] = lse(step + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        mark = np.exp(alpha + beta - z[:, None, None])
        rows, places = np.arange(n)[:, None], np.arange(width)[None]
        gold = e[rows, places, y].sum(1) + step[y[:, :-1], y[:, 1:]].sum(1)
        de = mark
        de[rows, places, y] -= 1
        pairs = np.exp(alpha[:, :-1, :, None] + step + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        g = {"next": pairs.sum((0, 1))}
        np.add.at(g["next"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        de /= n
        g["next"] /= n
        g["out"] = h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)
        g["bias"] = de.sum((0, 1))
        dh_all = de @ self.p["out"].T
        for d, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            dx, dw = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"])
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for t, h0, c0, i, f, o, u, tc in reversed(past[d]):
                dh = dh + dh_all[:, t, half]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * u * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], 1)
                np.add.at(dx, x[:, t], dz)
                dw += h0.T @ dz
                dh, dc = dz @ self.p[f"h{d}"].T, dc * f
            g[f"x{d}"], g[f"h{d}"] = dx, dw
        return float((z - gold).mean()), g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> list[float]:
        """Adam over shuffled batches; the mean loss of each pass."""
        rng, m, v, k, losses = np.random.default_rng(seed), {}, {}, 0, []
        for epoch in range(epochs):
            order, total = rng.permutation(len(x)), []
            for a in range(0, len(x), BATCH):
                at = order[a : a + BATCH]
                loss, g = self.gradient(x[at], y[at])
                total.append(loss)
                k += 1
                norm = np.sqrt(sum(float((w * w).sum()) for w in g.values()))
                rate = RATE * (1 - epoch / (epochs + 1))
                for name, w in g.items():
                    w = w * min(1.0, 5 / (norm + 1e-9))
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * w
                    v[name] = 0.99 * v.get(name, 0) + 0.01 * w * w
                    self.p[name] -= (rate * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(total)))
        return losses


def windows_of(length: int) -> range:
    """Starts of the windows over a text: half a window apart."""
    return range(0, max(1, length - STRIDE), STRIDE)


def labelled(text: str, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """A training window: base spans and quoted secrets are its labels, and some are rewritten as the same data in other forms or places.

    Numbers of a card's shape are labelled whatever their check digit says,
    which a character tagger cannot learn; ``additions`` tests it. None for a
    window with other text that may be such data.
    """
    spans = [(k, a, b) for k, a, b in base_spans(text) if k != "card"]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if 14 <= len(_only_digits(m[0])) <= 19]
    spans += [("secret", *m.span(1)) for m in _QUOTED.finditer(text)]
    inside = np.zeros(len(text) + 1, bool)
    for _, a, b in spans:
        inside[a:b] = True
    if not text or _UNSURE.search("".join("~" if inside[k] else c for k, c in enumerate(text))):
        return None
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    taken, at, out, tags = [], 0, [], []

    def put(kind: str | None, piece: str) -> None:
        out.append(piece)
        k = None if kind is None else KINDS.index(kind)
        tags.extend([0] * len(piece) if k is None else [1 + 2 * k] + [2 + 2 * k] * (len(piece) - 1))

    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if taken and a < taken[-1]:
            continue
        taken.append(b)
        piece, form = text[a:b], rng.integers(4)
        put(None, text[at:a])
        if kind == "phone" and form:
            number = _only_digits(piece)
            tail = [number[:-10], number[-10:-7], number[-7:-4], number[-4:]]
            piece = "-".join(filter(None, tail)) if form == 1 else ".".join(filter(None, tail)) if form == 2 else f"({tail[1]}) {tail[2]}-{tail[3]}"
        elif kind == "card" and form > 1:
            number = _only_digits(piece)
            piece = "./"[form - 2].join(number[k : k + 4] for k in range(0, len(number), 4))
        elif kind == "email" and form == 3:
            piece = piece.replace("@", " @ ")
        elif kind == "secret":
            piece = piece[: rng.integers(20, len(piece) + 1)] if form == 3 else piece
            if form and text[at:a][-1:] in ('"', "'"):  # not in quotes
                del tags[-1]
                out[-1] = out[-1][:-1]
                b += text[b : b + 1] in ("'", '"')
        put(kind, piece)
        if kind in ("phone", "card") and rng.integers(3) == 0:  # numbers that follow, as the patterns run on into them
            put(None, " ")
            if rng.integers(2):
                put(None, digits(int(rng.integers(1, 5))))
            else:
                put("ip", ".".join(map(str, rng.integers(0, 256, 4))))
        at = b
    put(None, text[at:])
    whole = "".join(out)[:WIDTH]
    x, y = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
    x[: len(whole)], y[: len(whole)] = classes(whole), tags[: len(whole)]
    return x, y


def train_tagger(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """A tagger from about ``sample`` windows with a digit or an at-sign, chosen by a hash; None if there is none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(0):
                text, end = x.as_py() or "", -1
                for m in _ANCHOR.finditer(text):
                    if m.start() >= end:
                        a = max(0, m.start() - STRIDE)
                        out.append(text[a : a + WIDTH])
                        end = a + WIDTH
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["w"])

    windows = staged(docs.select(text_col).mapInArrow(cut, "w string").distinct())
    chosen = sorted(hash_sample(windows, "w", sample).collect())
    if not chosen:
        return None
    rng = np.random.default_rng(5)
    # Few windows are rewritten several times, so that training is alike at every size.
    pairs = [p for _ in range(-(-sample // len(chosen))) for r in chosen if (p := labelled(r.w, rng))]
    if not pairs:
        return None
    x, y = zip(*pairs, strict=True)
    tagger = Tagger.start()
    tagger.fit(np.array(x), np.array(y))
    return tagger


def _sound(kind: str, text: str) -> bool:
    """What a span of the tagger must be to count."""
    digits = _only_digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s?@\s?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text)) and _octets(text)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9]+(?:[ ./-][0-9]+){0,6}", text))
    if kind == "secret":
        return bool(re.fullmatch(r"[0-9A-Za-z_-]{20,}", text)) and len(digits) >= 3 and sum(map(str.isalpha, text)) >= 3
    parts = re.findall(r"[0-9]+", text)
    return 10 <= len(digits) <= 15 and len(parts) >= 3 and max(map(len, parts)) <= 5 and len(parts[-1]) >= 4 and bool(re.fullmatch(r"[ ().0-9+-]+", text))


def additions(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Sound spans of a text's reconciled tags that touch no base span."""
    out, k, n = [], 0, len(tags)
    taken = np.zeros(n + 1, bool)
    for _, a, b in base:
        taken[a:b] = True
    starts = np.flatnonzero((tags > 0) & ((tags % 2 == 1) | (np.concatenate([[0], tags[:-1]]) == 0)))
    for a in starts.tolist():
        if a < k:
            continue
        kind, b = KINDS[(int(tags[a]) - 1) // 2], a + 1
        while b < n and tags[b] == 2 + 2 * KINDS.index(kind):
            b += 1
        k = b
        while a < b and text[b - 1] in " .,;:(-":
            b -= 1
        while a < b and text[a] in " .,;:)-":
            a += 1
        cut_off = (a > 0 and (text[a - 1].isalnum() or text[a - 1] in "@._-+/")) or (b < n and (text[b].isalnum() or text[b] in "@_-/"))
        if a < b and not cut_off and not taken[a:b].any() and _sound(kind, text[a:b]):
            out.append((kind, a, b))
    return out


def best_tags(shares: list[np.ndarray]) -> list[np.ndarray]:
    """The best tags of sequences of tag probabilities, among those where a kind goes on only from its own tags."""
    step, out = Tagger.allowed(), [np.empty(0, np.int8)] * len(shares)
    order = sorted(range(len(shares)), key=lambda k: len(shares[k]))
    for k in range(0, len(order), 128):
        some = order[k : k + 128]
        width = len(shares[some[-1]])
        e = np.full((len(some), width, TAGS), -1e4, np.float32)
        e[:, :, 0] = 0  # what follows a sequence is outside
        for r, j in enumerate(some):
            e[r, : len(shares[j])] = np.log(np.maximum(shares[j], 1e-6))
        score, back = e[:, 0].copy(), np.zeros((len(some), width, TAGS), np.int8)
        score[:, 2::2] = -1e4  # and what comes before it
        for t in range(1, width):
            both = score[:, :, None] + step
            back[:, t] = both.argmax(1)
            score = both.max(1) + e[:, t]
        tags = np.empty((len(some), width), np.int8)
        tags[:, -1] = score.argmax(1)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(len(some)), t, tags[:, t]]
        for r, j in enumerate(some):
            out[j] = tags[r, : len(shares[j])]
    return out


def tag_texts(texts: list[str], tagger: Tagger) -> list[np.ndarray]:
    """Tags of whole texts, reconciled from overlapping windows.

    A span must hold a digit or an at-sign, so only windows with one have a
    say. Each stretch that such windows cover gets the mean of their tag
    probabilities, the middle of a window weighing most, and one decoding of
    the whole stretch gives its tags. All else is outside.
    """
    tags = [np.zeros(len(t), np.int8) for t in texts]
    todo, rows = [], []
    for d, t in enumerate(texts):
        last = windows_of(len(t))[-1] // STRIDE
        near = {k for m in _ANCHOR.finditer(t) for k in (m.start() // STRIDE, m.start() // STRIDE - 1, min(last, m.start() // STRIDE))}
        for k in sorted(near):
            w = t[k * STRIDE : k * STRIDE + WIDTH]
            if 0 <= k <= last and _ANCHOR.search(w):
                todo.append((d, k * STRIDE))
                rows.append(w)
    weight = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(np.float32)
    stretches, at = [], []  # sums of probabilities and of weights
    for k in range(0, len(todo), 512):
        part = rows[k : k + 512]
        x = np.zeros((len(part), WIDTH), np.int64)
        for r, w in enumerate(part):
            x[r, : len(w)] = classes(w)
        found = tagger.marginals(x)
        for (d, a), share, w in zip(todo[k : k + 512], found, part, strict=True):
            n = len(w)
            if at and at[-1][0] == d and at[-1][1] + len(stretches[-1][-1][1]) + stretches[-1][-1][2] > a:
                stretches[-1].append((share[:n] * weight[:n, None], weight[:n], a - at[-1][1]))
            else:
                at.append((d, a))
                stretches.append([(share[:n] * weight[:n, None], weight[:n], 0)])
    means = []
    for parts in stretches:
        size = max(a + len(w) for _, w, a in parts)
        total, whole = np.zeros((size, TAGS), np.float32), np.zeros(size, np.float32)
        for share, w, a in parts:
            total[a : a + len(w)] += share
            whole[a : a + len(w)] += w
        means.append(total / whole[:, None])
    for (d, a), got in zip(at, best_tags(means), strict=True):
        tags[d][a : a + len(got)] = got
    return tags


def find_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans with those the tagger adds, of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, b) for b in base]
    hot = [k for k, t in enumerate(texts) if _ANCHOR.search(t)]
    tags = dict(zip(hot, tag_texts([texts[k] for k in hot], tagger), strict=True))
    out = []
    for k, (t, b) in enumerate(zip(texts, base, strict=True)):
        more = additions(t, tags[k], b) if k in tags and tags[k].any() else []
        out.append((b, sorted(b + more, key=lambda s: (s[1], KINDS.index(s[0])))))
    return out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``id_col, base, spans`` of each row: ARRAY<STRUCT<kind, start, end>> in code points, end exclusive.

    ``base`` has what the fixed patterns find, ``spans`` also what the tagger
    adds: secrets, other forms, and data that a pattern loses because it runs
    on into the next number.

    Spans of a kind do not overlap; those of different kinds may. Null texts
    are empty, rows without an id are left out, repeated rows are returned as
    often as they occur, other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train_tagger(docs, text_col, sample))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find_spans([x.as_py() or "" for x in b.column(1)], shared.value)
            lists = [pa.array([[{"kind": k, "start": x, "end": y} for k, x, y in f[c]] for f in found], kind) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], [id_col, "base", "spans"])

    spans = "array<struct<kind:string,start:int,end:int>>"
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col).mapInArrow(run, f"`{id_col}` long, base {spans}, spans {spans}")


def masked(text: str, spans: list[Span]) -> str:
    """A text with ``<kind>`` in place of its spans; spans that overlap become one, named after the first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with spans masked in ``text_col``, also those that a pattern finds once their neighbours are masked, and ``length_col`` set to the new length where there is such a column.

    Null texts stay null. Rows and other columns stay as they are.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train_tagger(docs, text_col, sample))

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        plain = texts.to_pylist()
        found = find_spans([t or "" for t in plain], shared.value)
        out = []
        for t, (_, spans) in zip(plain, found, strict=True):
            while spans:
                t = masked(t, spans)
                spans = base_spans(t)
            out.append(t)
        return pa.array(out, pa.string())

    out = docs.withColumn(text_col, mask(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length(text_col).cast(docs.schema[length_col].dataType)))
    return out
