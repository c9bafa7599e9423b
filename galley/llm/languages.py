"""Language of every document and of its parts, by a convolutional network on bytes.

A text falls into segments: its title, and the sentences of its body. The bytes of every segment are cut into windows of
fixed length, and one network judges all windows of a batch: byte embedding, filters of several widths, maximum over the window, and
softmax over the languages. It is trained here, in numpy, on windows of labelled documents. Words with a capital letter are masked, and
windows that hold nothing but them and numbers are trained towards no language at all, so that a name decides nothing. A segment has the mean
log-probability of its windows. What stands in quotation marks inside a sentence counts only where little else is left.

The training starts on a bounded number of windows. A pass over all documents goes on from there: every window of their whole texts is judged, and those
whose language the network does not know surely yet take it further. Tasks do so apart, and the mean of their networks, by windows, is the network. An eighth
of the documents, by hash, is held out from both.

The language of an item is that of most of its bytes. A segment in another language is one whose evidence against the language of the rest
is above a margin, which is validated on all held-out documents with and without a foreign sentence and grows with the logarithm of the number of sentences. Passages in the
wrong encoding are restored before.

A pure map after training, over whole texts. Defined cases: null and empty texts have no segments, and an item without
any has no language (null, confidence 0); the title "(no title)" counts as none; repeated rows are judged alike; extra columns are
ignored; a text of any length is judged whole.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread, table
from . import garbled
from .training import sample, summed

LANGUAGES = ("en", "fr", "de", "es", "pt", "it", "nl", "ru", "ja")
#: ISO 639-2 codes of these languages (fixed values).
THREE = {"eng": "en", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "spa": "es", "por": "pt", "ita": "it", "nld": "nl", "dut": "nl", "rus": "ru", "jpn": "ja"}
WINDOW, DIM = 96, 8
WIDTHS = ((2, 12), (3, 20), (4, 28), (5, 36))
WIDEST = max(w for w, _ in WIDTHS)
FILTERS = sum(n for _, n in WIDTHS)
#: Bounds of the start of the training; the pass after it has none.
TRAINING_ROWS, TRAINING_WINDOWS, EPOCHS = 4000, 26_000, 5
#: From this probability on a window's language is known, and the window takes the network no further.
KNOWN = 0.9
RATE, BATCH, UNIT = 0.0005, 128, 1 << 20

_END = re.compile(r"(?<=[.!?…])[\"”’»“)\]]*\s+|(?<=[。！？])(?![」』）])\s*|\n+")
_QUOTED = re.compile(r"“[^“”]{1,400}”|«[^«»]{1,400}»|„[^„“”]{1,400}[“”]|\"[^\"]{1,400}\"|「[^「」]{1,400}」")
_LOWER = re.compile(r"\b[a-zß-öø-ÿа-яё][\w’']*")


def label(text: str | None) -> str | None:
    """The language that a label in any common spelling names; None where it names none."""
    code = re.split(r"[-_]", (text or "").strip().lower())[0]
    if code in ("", "und", "unknown", "null", "none"):
        return None
    return THREE.get(code, code)


def sentences(text: str) -> list[tuple[int, int]]:
    """The places of the sentences of a text: ends of sentences and lines cut it."""
    out, at = [], 0
    for m in _END.finditer(text):
        end = m.end()
        if text[at:end].strip():
            out.append((at, end))
            at = end
    if text[at:].strip():
        out.append((at, len(text)))
    return out


_NAME = re.compile(r"\b[A-ZÀ-ÞŠŽĆČА-ЯЁ][\w’'\-]*")


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point, whether it is a capital letter, and a letter."""
    return tuple(np.array([f(chr(c)) for c in range(0x110000)]) for f in (str.isupper, str.isalpha))


def capitals(text: str) -> bool:
    """Whether a text is written in capitals, small additions aside."""
    if len(text) <= 12:
        return False
    upper, alpha = _letters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    big = int(np.count_nonzero(upper[codes]))
    return big > 12 and big > 0.6 * int(np.count_nonzero(alpha[codes]))


def bare(sentence: str) -> str:
    """A sentence without what it quotes, if enough is left to tell its language, and with X for names.

    Names are words with a capital letter, but for a short first word.
    """
    left = _QUOTED.sub(" ", sentence)
    if left != sentence and (len(_LOWER.findall(left)) >= 3 or sum("\u3040" <= c <= "\u9fff" for c in left) >= 4):
        sentence = left
    if sentence.isupper() or capitals(sentence):
        return sentence.lower()
    start = len(sentence) - len(sentence.lstrip(" «“„\"‘"))
    return _NAME.sub(lambda m: m.group().lower() if m.start() == start and len(m.group()) <= 4 else "X", sentence)


def whole(part: str, text: str) -> bool:
    """Whether a segment is enough of a sentence to make an item mixed: names, credits and short remains of cuts are not."""
    words = _LOWER.findall(text)
    ended = part == "title" or re.search(r"[.!?…。！？][\"”’»“)\]]*$", text.rstrip()) is not None and "..." not in text[-8:]
    return len(words) >= (3 if ended else 5) or capitals(text) and len(text.split()) >= 4 or sum("\u3040" <= c <= "\u9fff" for c in text) >= 6


def windows(data: bytes) -> np.ndarray:
    """The bytes of a segment as rows of WINDOW; the last row ends where the segment ends, short ones are filled with 0."""
    return all_windows([data])[0]


def all_windows(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all segments in turn, and how many each has."""
    rows, counts = [], np.ones(len(segments), np.int64)
    for i, data in enumerate(segments):
        n = len(data)
        if n <= WINDOW:
            rows.append(data.ljust(WINDOW, b"\0"))
            continue
        rows += [data[s : s + WINDOW] for s in range(0, n - WINDOW, WINDOW)]
        rows.append(data[n - WINDOW :])
        counts[i] = -(-n // WINDOW)
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WINDOW), counts


class Network:
    """Byte convolution of several widths, max pooling and softmax."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.e[0] = 0
        self.mask = np.zeros((WIDEST * DIM, FILTERS), np.float32)
        k = 0
        for w, n in WIDTHS:
            self.mask[: w * DIM, k : k + n] = 1
            k += n
        self.w = rng.normal(0, 0.25, self.mask.shape).astype(np.float32) * self.mask
        self.b = np.zeros(FILTERS, np.float32)
        self.v = rng.normal(0, 0.2, (FILTERS, len(LANGUAGES))).astype(np.float32)
        self.c = np.zeros(len(LANGUAGES), np.float32)

    def _patches(self, x: np.ndarray) -> np.ndarray:
        rows = np.lib.stride_tricks.sliding_window_view(self.e[x].reshape(len(x), WINDOW * DIM), WIDEST * DIM, axis=1)[:, ::DIM]
        return np.ascontiguousarray(rows).reshape(-1, WIDEST * DIM)

    def logp(self, x: np.ndarray, block: int = 64) -> np.ndarray:
        """Log-probabilities of the languages for each window."""
        out = np.empty((len(x), len(LANGUAGES)), np.float32)
        for s in range(0, len(x), block):
            part = x[s : s + block]
            h = (self._patches(part) @ self.w).reshape(len(part), -1, FILTERS).max(1) + self.b
            z = np.maximum(h, 0) @ self.v + self.c
            z -= z.max(1, keepdims=True)
            out[s : s + block] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out

    PARAMS = ("e", "w", "b", "v", "c")
    SIZE = 256 * DIM + WIDEST * DIM * FILTERS + FILTERS + FILTERS * len(LANGUAGES) + len(LANGUAGES)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.PARAMS])

    def take(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.PARAMS:
            value = getattr(self, k)
            setattr(self, k, flat[at : at + value.size].astype(np.float32).reshape(value.shape))
            at += value.size

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy with the distributions ``y``, windows weighted."""
        places, n = WINDOW - WIDEST + 1, len(x)
        patches = self._patches(x)
        conv = (patches @ self.w).reshape(n, places, FILTERS)
        at = conv.argmax(1)
        h = np.take_along_axis(conv, at[:, None], 1)[:, 0] + self.b
        a = np.maximum(h, 0)
        keep = (rng.random(a.shape) < 0.8).astype(np.float32) / 0.8
        z = (a * keep) @ self.v + self.c
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        dz = (p - y) * weight[:, None] / n
        dh = (dz @ self.v.T) * keep * (h > 0)
        where = (np.arange(n)[:, None] * places + at).ravel()
        chosen = patches[where].reshape(n, FILTERS, -1)
        dw = np.einsum("nf,nfk->kf", dh, chosen, optimize=True) * self.mask
        dpatch = (dh[:, :, None] * self.w.T[None]).reshape(n * FILTERS, WIDEST, DIM)
        de = np.zeros_like(self.e)
        signs = x[np.repeat(np.arange(n), FILTERS)[:, None], at.ravel()[:, None] + np.arange(WIDEST)].ravel()
        for j in range(DIM):
            de[:, j] = np.bincount(signs, weights=dpatch[:, :, j].ravel(), minlength=256)
        de[0] = 0
        return {"e": de, "w": dw, "b": dh.sum(0), "v": (a * keep).T @ dz, "c": dz.sum(0)}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int = 4, rate: float = 0.004) -> None:
        """Adam on the cross-entropy with the distributions ``y``."""
        rng, adam, weight = np.random.default_rng(seed), Adam(self), np.ones(BATCH, np.float32)
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for s in range(0, len(order), BATCH):
                rows = order[s : s + BATCH]
                adam.step(self.gradients(x[rows], y[rows], weight[: len(rows)], rng), rate * (1 - 0.9 * (epoch * len(order) + s) / (epochs * len(order))))


class Adam:
    """Steps of a network along gradients."""

    def __init__(self, network: Network):
        self.network, self.steps = network, 0
        self.first, self.second = ({p: np.zeros_like(getattr(network, p)) for p in Network.PARAMS} for _ in range(2))

    def step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        for k, g in grads.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.002 * (g**2 - self.second[k])
            value = getattr(self.network, k)
            value -= (rate * (self.first[k] / (1 - 0.9**self.steps)) / (np.sqrt(self.second[k] / (1 - 0.998**self.steps)) + 1e-7)).astype(np.float32)


class Judge:
    """A trained network with its margin; judges items."""

    def __init__(self, network: Network, margin: float, repair: tuple | None):
        self.network, self.margin, self.repair = network, margin, repair

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "repairer"}

    @functools.cached_property
    def repairer(self) -> garbled.Repairer | None:
        """What it has read of words is kept from batch to batch."""
        return garbled.Repairer(*self.repair) if self.repair else None

    def parts(self, title: str | None, body: str | None) -> list[tuple[str, int, int, str]]:
        """(part, start, end, text to judge) of the segments of an item; places are those of the restored text."""
        out = []
        if title and title.strip() and title.strip().lower() != "(no title)":
            head = title.split(" | ")[0] if len(title.split(" | ")[0]) > 12 else title
            out.append(("title", 0, len(title), bare(head)))
        if body:
            out += [("body", s, e, bare(body[s:e])) for s, e in sentences(body)]
        return out

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum over its bytes' windows, as mean times the square root of their number, of the log-probabilities of each text; bytes."""
        if not texts:
            return np.zeros((0, len(LANGUAGES))), np.zeros(0)
        data = [t.encode("utf-8", "replace") for t in texts]
        rows, n = all_windows(data)
        logp = self.network.logp(rows)
        total = np.add.reduceat(logp, np.cumsum(n) - n, axis=0)
        return total / np.sqrt(n)[:, None], np.array([len(d) for d in data])

    def items(self, titles: list[str | None], bodies: list[str | None]) -> list[dict]:
        """For each item: lang, confidence, languages, and its segments (part, start, end, lang, confidence)."""
        repairer = self.repairer
        fix = (lambda t: repairer.restored(t)[0]) if repairer else (lambda t: t)
        each = [self.parts(fix(t), fix(b)) for t, b in zip(titles, bodies, strict=True)]
        score, size = self.evidence([p[3] for parts in each for p in parts])
        out, at = [], 0
        for parts in each:
            k = len(parts)
            out.append(self._judged(parts, score[at : at + k], size[at : at + k]))
            at += k
        return out

    def _judged(self, parts: list, score: np.ndarray, size: np.ndarray) -> dict:
        if not parts:
            return {"lang": None, "confidence": 0.0, "languages": [], "segments": []}
        best = score.argmax(1)
        weight = np.bincount(best, weights=np.minimum(size, 400) * np.exp(score.max(1)), minlength=len(LANGUAGES))
        # ties fall to the likelier over all
        main = int(np.lexsort((score.sum(0), weight))[-1])
        other = score[np.arange(len(best)), best] - score[:, main] > self.margin + leeway(len(parts))
        other &= np.array([o and whole(p[0], p[3]) for o, p in zip(other.tolist(), parts, strict=True)], bool)
        lang = np.where(other, best, main)
        segments: list[list] = []
        for (part, start, end, _), code, row in zip(parts, lang.tolist(), score, strict=True):
            sure = float(np.exp(row[code]))
            if segments and segments[-1][0] == part and segments[-1][3] == code:
                segments[-1][2] = end
                segments[-1][4].append(sure)
            else:
                segments.append([part, start, end, code, [sure]])
        share = np.bincount(lang, weights=size, minlength=len(LANGUAGES)) / max(size.sum(), 1)
        sure = float(np.average(np.exp(score[lang == main, main]), weights=size[lang == main])) if (lang == main).any() else 0.0
        return {
            "lang": LANGUAGES[main],
            "confidence": sure * float(share[main]),
            "languages": [LANGUAGES[k] for k in sorted(set(lang.tolist()), key=lambda k: (-share[k], k))],
            "segments": [(p, s, e, LANGUAGES[c], float(np.mean(x))) for p, s, e, c, x in segments],
        }


def _disturbed(rng: np.random.Generator, text: str) -> str:
    """Some training sentences in capitals, with lost characters, or cut."""
    r = rng.random()
    if r < 0.08:
        return text.upper()
    if r < 0.12:
        sign = "?" if r < 0.1 else garbled.LOST
        return "".join(c if ord(c) < 128 else sign for c in text)
    if r < 0.3 and len(text) > 40:
        k = int(rng.integers(10, len(text) - 10))
        return text[:k] if r < 0.24 else text[k:]
    return text


def held_out(text: str) -> bool:
    """An eighth of the documents, copies of a text alike."""
    return zlib.crc32(text.encode("utf-8", "replace")) % 8 == 0


def units_of(text: str, lang: int) -> list[str]:
    """The sentences of a document that tell its language."""
    parts = (text[s:e].strip() for s, e in sentences(text))
    return [part for part in parts if len(list(islice(_LOWER.finditer(part), 2))) == 2 or LANGUAGES[lang] == "ja"]


def _with_word(part: str, accented: list[str], i: int) -> str:
    """Every eighth part gets a word with foreign signs, which is no language."""
    if not accented or i % 8:
        return part
    word = accented[i // 8 % len(accented)]
    return f"{part} – {word} X" if i % 16 else f"{word} {part}"


def _target(k: int) -> np.ndarray:
    return np.eye(len(LANGUAGES), dtype=np.float32)[k] * 0.98 + 0.02 / len(LANGUAGES)


def begun(rows: list[tuple[str, int, str]], rng: np.random.Generator, max_windows: int, epochs: int) -> tuple[Network, list[str]]:
    """From (text, language, title): a network to go on from, and words with foreign signs."""
    units: list[list[str]] = [[] for _ in LANGUAGES]
    heads: list[list[str]] = [[] for _ in LANGUAGES]
    for text, k, head in rows:
        if head and head != "(no title)":
            heads[k].append(head)
        units[k] += units_of(text, k)
    accented = [w for u in units for part in u for w in part.split(" ") if not w.isascii() and w.isalpha()]
    network = Network()
    present = [k for k in range(len(LANGUAGES)) if units[k]]
    if not present:
        return network, accented
    x, y = [], []
    for k in present:
        take = int(max_windows * len(units[k]) ** 0.5 / sum(len(units[j]) ** 0.5 for j in present))
        for i, r in zip(rng.integers(0, 1 << 30, take), rng.random(take), strict=True):
            pool = heads[k] if heads[k] and r < 0.25 else units[k]
            part = _with_word(bare(_disturbed(rng, pool[i % len(pool)])), accented, int(i))
            w = windows(part.encode("utf-8", "replace"))
            x.append(w[rng.integers(len(w))])
            y.append(_target(k))
    for _ in range(max_windows // 40):
        x.append(_nameless(rng))
        y.append(np.full(len(LANGUAGES), 1 / len(LANGUAGES), np.float32))
    network.train(np.stack(x), np.stack(y), epochs)
    return network, accented


def _nameless(rng: np.random.Generator) -> np.ndarray:
    """A window of nothing but names and numbers."""
    part = [str(rng.choice(["X", "X", "X", str(rng.integers(2, 90_000))])) for _ in range(rng.integers(1, 7))]
    return windows(rng.choice([", ", " ", " | ", " / ", " – "]).join(part).encode())[0]


class Pass:
    """Takes a network further by all windows of the documents it is given."""

    def __init__(self, network: Network, accented: list[str], sizes: np.ndarray):
        self.network, self.accented, self.adam = network, accented, Adam(network)
        weight = np.where(sizes > 0, np.maximum(sizes, 1.0) ** -0.5, 0)
        self.weight = (weight * sizes.sum() / max((weight * sizes).sum(), 1e-9)).astype(np.float32)
        self.rng, self.seen, self.learned = np.random.default_rng(5), 0, 0
        self.x, self.k = np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)

    def add(self, rows: list[tuple[str, int, str]]) -> None:
        """(text, language, title) of documents that are not held out."""
        segments, k = [], []
        for text, lang, head in rows:
            rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
            parts = units_of(text, lang) + ([head] if head and head != "(no title)" else [])
            for part, i in zip(parts, rng.integers(0, 1 << 30, len(parts)).tolist(), strict=True):
                segments.append(_with_word(bare(_disturbed(rng, part)), self.accented, i).encode("utf-8", "replace"))
            k += [lang] * len(parts)
        if not segments:
            return
        x, n = all_windows(segments)
        k = np.repeat(k, n)
        self.seen += len(x)
        unknown = np.exp(self.network.logp(x)[np.arange(len(x)), k]) < KNOWN
        self.x, self.k = np.concatenate([self.x, x[unknown]]), np.concatenate([self.k, k[unknown]])
        while len(self.x) >= BATCH:
            self._step()

    def _step(self) -> None:
        x, k = self.x[:BATCH], self.k[:BATCH]
        self.x, self.k = self.x[BATCH:], self.k[BATCH:]
        self.learned += len(x)
        blank = max(1, len(x) // 40)
        y = np.stack([_target(j) for j in k.tolist()] + [np.full(len(LANGUAGES), 1 / len(LANGUAGES), np.float32)] * blank)
        x = np.concatenate([x, np.stack([_nameless(self.rng) for _ in range(blank)])])
        self.adam.step(self.network.gradients(x, y, np.r_[self.weight[k], np.ones(blank, np.float32)].astype(np.float32), self.rng), RATE)

    def end(self) -> Network:
        if len(self.x):
            self._step()
        return self.network


def deviations(judge: Judge, held: list[tuple[str, int]], rng: np.random.Generator) -> Counter:
    """How often comes what, by (kind, hundredths), at held-out documents, by the rule that judges items.

    "alone" is the evidence of the most deviating sentence of a document against its language, "mixed" that of a sentence of another
    one in place of it, "right" says whether the language is the label.
    """
    places = [sentences(text) for text, _ in held]
    each = [[bare(text[s:e]) for s, e in spans] for spans, (text, _) in zip(places, held, strict=True)]
    score, size = judge.evidence([p for parts in each for p in parts])
    pool: list[list[np.ndarray]] = [[] for _ in LANGUAGES]
    spans, at = [], 0
    for where, (_, k) in zip(places, held, strict=True):
        spans.append((at, at + len(where)))
        pool[k] += [score[at + i] for i, (s, e) in enumerate(where[:6]) if e - s > 30]
        at += len(where)
    got: Counter = Counter()
    for (s, e), (_, k) in zip(spans, held, strict=True):
        if s == e:
            continue
        row = score[s:e]
        main = int(np.bincount(row.argmax(1), weights=size[s:e], minlength=len(LANGUAGES)).argmax())
        allowed = leeway(e - s)
        got["right", int(main == k)] += 1
        got["alone", round(100 * (float((row.max(1) - row[:, main]).max()) - allowed))] += 1
        if others := [j for j in range(len(LANGUAGES)) if j != k and pool[j]]:
            j = int(rng.choice(others))
            foreign = pool[j][int(rng.integers(len(pool[j])))]
            got["mixed", round(100 * (float(foreign[j] - foreign[main]) - allowed))] += 1
    return got


def leeway(sentences: int) -> float:
    """The more sentences, the likelier one of them deviates by chance."""
    return 0.5 * float(np.log(max(1.0, sentences / 8)))


def margin_of(counts: dict[tuple[str, int], int]) -> tuple[float, dict]:
    """The margin that holds the fewest single documents to be mixed and misses the fewest mixed ones, and its figures."""
    v = {kind: np.repeat(*zip(*sorted((x, n) for (k, x), n in counts.items() if k == kind), strict=True)) if any(k == kind for k, _ in counts) else np.zeros(0) for kind in ("alone", "mixed")}
    a, m = v["alone"] / 100, v["mixed"] / 100
    if not len(a) or not len(m):
        return 2.0, {}
    # a few documents are mixed themselves
    options = np.linspace(0.5, 6, 56)
    wrong = 1 - np.searchsorted(a, options) / len(a) + np.searchsorted(m, options) / len(m)
    margin = float(np.mean(options[wrong <= wrong.min() + 1e-9]))
    return margin, {"held_out": len(a), "wrong_language": counts.get(("right", 0), 0), "margin": margin, "single_held_mixed": int((a > margin).sum()), "mixed_missed": int((m <= margin).sum())}


def fit(labelled: list[tuple[str, str, str | None]], repair: tuple | None = None, *, max_windows: int = TRAINING_WINDOWS, epochs: int = EPOCHS, seed: int = 9) -> tuple[Judge, dict]:
    """From (text, language, title): a judge, and its held-out figures; the rule that ``trained`` follows on tables."""
    rng = np.random.default_rng(seed)
    rows = [(t, LANGUAGES.index(k), h or "") for t, k, h in labelled if t and k in LANGUAGES]
    rng.shuffle(rows)
    rows = [(str(t), int(k), str(h)) for t, k, h in rows]
    rest = [r for r in rows if not held_out(r[0])]
    step = Pass(*begun(rest, rng, max_windows, epochs), np.bincount([k for _, k, _ in rows], minlength=len(LANGUAGES)))
    step.add(rest)
    judge = Judge(step.end(), 2.0, repair)
    judge.margin, figures = margin_of(deviations(judge, [(t, k) for t, k, _ in rows if held_out(t)], rng))
    return judge, {"documents": len(rows)} | figures


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, int, str]]]:
    for whole in batches:
        for b in (whole.slice(i, 400) for i in range(0, whole.num_rows, 400)):
            yield [(t, LANGUAGES.index(k), h or "") for t, k, h in zip(*(c.to_pylist() for c in b.columns), strict=True)]


def _passed(shared):
    """The windows seen and learned from, and the way the network went, weighted by the windows seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        network, accented, sizes = shared.value
        start = network.flat().astype(np.float64)
        mine = Network()
        mine.take(start)
        step = Pass(mine, accented, sizes)
        for rows in _documents(batches):
            step.add(rows)
        way = step.end().flat().astype(np.float64) - start
        return np.r_[step.seen, step.learned, np.rint(way * step.seen * UNIT)].astype(np.int64)

    return run


def _deviated(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        rng = np.random.default_rng(6)
        for rows in _documents(batches):
            got.update(deviations(shared.value, [r[:2] for r in rows], rng))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()), pa.array([v for _, v in got], pa.int64()), pa.array(list(got.values()), pa.int64())], names=["kind", "value", "n"])

    return run


def trained(spark: SparkSession, sf_dir: str, *, training_rows: int = TRAINING_ROWS) -> tuple[Judge, dict]:
    """Fits on all labelled documents, as ``fit`` does, and the repair of encodings on all items; ``training_rows`` bounds the documents of the start only.

    What reaches the driver are the start, sums of fixed size, and counts of deviations by hundredths.
    """
    context = spark.sparkContext
    docs = table(spark, sf_dir, "documents").select("text", "lang", "title", "doc_id").where(F.col("lang").isin(*LANGUAGES) & (F.col("text") != ""))
    held = F.crc32(F.col("text").cast("binary")) % 8 == 0
    start = sample(docs.where(~held), "doc_id", training_rows, {"text": 2500, "title": 300})
    sizes = np.zeros(len(LANGUAGES))
    for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[LANGUAGES.index(r.lang)] = r.n
    network, accented = begun([(r.text, LANGUAGES.index(r.lang), r.title or "") for r in start], np.random.default_rng(9), TRAINING_WINDOWS, EPOCHS)
    docs = docs.select("text", "lang", "title")
    sums = summed(spread(docs.where(~held)), _passed(context.broadcast((network, accented, sizes))), 2 + Network.SIZE)
    network.take(network.flat() + sums[2:] / (max(int(sums[0]), 1) * UNIT))
    items = table(spark, sf_dir, "preprocessed_items").select("id", "title", "body_text")
    judge = Judge(network, 2.0, garbled.trained(items, ["title", "body_text"]))
    counts = spread(docs.where(held)).mapInArrow(_deviated(context.broadcast(judge)), "kind string, value bigint, n bigint").groupBy("kind", "value").agg(F.sum("n").alias("n")).collect()
    judge.margin, figures = margin_of({(r.kind, r.value): r.n for r in counts})
    return judge, {"documents": int(sizes.sum()), "windows": int(sums[0]), "learned": int(sums[1])} | figures


def _judge(shared, what: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for whole in batches:
            for b in (whole.slice(i, 400) for i in range(0, whole.num_rows, 400)):
                found = judge.items(b.column(1).to_pylist(), b.column(2).to_pylist())
                if what == "items":
                    cols = [b.column(0), *(pa.array([f[k] for f in found], t) for k, t in (("lang", pa.string()), ("confidence", pa.float64()), ("languages", pa.list_(pa.string()))))]
                    yield pa.RecordBatch.from_arrays(cols, names=["id", "lang", "confidence", "languages"])
                    continue
                row = np.repeat(np.arange(len(found)), [len(f["segments"]) for f in found])
                segments = [(i, *s) for f in found for i, s in enumerate(f["segments"])]
                kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64()]
                cols = [b.column(0).take(pa.array(row, pa.int64())), *(pa.array([s[k] for s in segments], t) for k, t in enumerate(kinds))]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "segment_no", "part", "start_char", "end_char", "lang", "confidence"])

    return run


def judged(items: DataFrame, judge: Judge, what: str = "items") -> DataFrame:
    """From (id, title, body): "items" (id, lang, confidence, languages) or "segments" (id, segment_no, part, start_char, end_char, lang, confidence)."""
    shared = items.sparkSession.sparkContext.broadcast(judge)
    kind = items.schema["id"].dataType.simpleString()
    schema = f"id {kind}, lang string, confidence double, languages array<string>" if what == "items" else f"id {kind}, segment_no int, part string, start_char int, end_char int, lang string, confidence double"
    return items.select("id", "title", "body").mapInArrow(_judge(shared, what), schema)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "preprocessed_items").select("id", "title", F.col("body_text").alias("body"), "lang_label", "is_english"))


def _wrong(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for whole in batches:
            for b in (whole.slice(i, 400) for i in range(0, whole.num_rows, 400)):
                found = judge.items(b.column(1).to_pylist(), b.column(2).to_pylist())
                row, lang = [], []
                for i, (f, known, english) in enumerate(zip(found, b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                    if len(f["languages"]) > 1 or f["lang"] and (label(known) != f["lang"] or english is None or english != (f["lang"] == "en")):
                        row += [i] * len(f["languages"])
                        lang += f["languages"]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(lang, pa.string())], names=["id", "lang"])

    return run


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2_found: the items whose labels miss or contradict their language, with it, and mixed items with each of theirs."""
    judge, _ = trained(spark, sf_dir)
    items = _items(spark, sf_dir)
    return items.mapInArrow(_wrong(spark.sparkContext.broadcast(judge)), "id bigint, lang string")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2_items: language, confidence and all languages of every item."""
    return judged(_items(spark, sf_dir), trained(spark, sf_dir)[0])


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2_segments: the stretches of one language in every item, with a confidence each."""
    return judged(_items(spark, sf_dir), trained(spark, sf_dir)[0], "segments")


QUERIES = {"p2_found": found, "p2_items": languages, "p2_segments": segments}
SQL: dict[str, str] = {}
