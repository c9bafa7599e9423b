"""Template residue, filler, error pages and demands for scripts in place of the real thing.

Two regularised logistic models on hashed features are trained here, on weak labels. The first judges units (titles, and
the sentences and lines of a text) by word and character n-grams with names and numbers masked, by the length of unit and text and by
whether it is a title. Its labels come from the records: those that a server answered with an error, or whose
text is mostly made of phrases of such pages or of stock lines that short texts of several hosts share, against texts that came well; a second round takes the
labels that the first one gives. The second model judges every expression in brackets of template languages by its delimiters, its
inside and what surrounds it; its labels are whether the same inside stands alone on some line or title.

A record is a case if its title is residue, if most of its text is, or if title or text holds an unfilled placeholder. A single
phrase inside an article (a report on an error page, a notice beside the full text, an editor's bracket) is no case. Both models
are validated on hosts that they were not trained on.

A pure map after training, over whole texts. Defined cases: null and empty texts are no cases, whatever the title; a null title is not judged; repeated
rows are judged alike; extra columns are ignored; without rows to train on nothing is found.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread, table
from .languages import sentences
from .training import sample

BITS = 18
TRAINING_ROWS, TRAINING_CHARS = 4000, 2500
_SPREAD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
SHORT = 700

#: Phrases that make a unit suspect when weak labels are given; the model generalises from them.
SEEDS = re.compile(
    r"lorem|ipsum|dolor sit|javascript|\bscripts?\b|noscript|browser|page not found|not found|\berror\b|http \d|code \d{3}|try again|retry|unavailable|placeholder|goes here|to come\b|dummy|"
    r"\bJS\b|enable|scripting|client-side|captcha|human|cookies|log in|session|blocked|forbidden|denied|gateway|too many requests|asdf|blah|insert |do not publish|address|activez|\bactive\b|aktiv|schakel|включите|navigateur|introuvable|erreur|nicht gefunden|fehler|"
    r"no encontrada|no está disponible|dirección|endereço|indirizzo|adresse\b|\badres\b|navegador|não encontrada|erro \d|non trovata|niet gevonden|не найден|ошибк|браузер|見つかりません|ブラウザ|エラー|有効にして",
    re.I,
)
_EXPRESSION = re.compile(r"\{\{[^{}\n]{0,60}\}\}|\{%[^{}\n]{0,60}%\}|[$#]\{[^{}\n]{0,60}\}|<%[^<>\n]{0,60}%>|\[\[[^\[\]\n]{0,60}\]\]|(?<!\w)__[\w.\-]{1,60}?__(?!\w)|%%[\w.\-]{1,60}%%|@@[\w.\-]{1,60}@@|\{[^{}\n]{0,60}\}|\[[^\[\]\n]{1,60}\]")
_NAME = re.compile(r"(?<=[^\W\d_,;»”] )[A-ZÀ-ÞŠŽĆČА-ЯЁ][^\W\d_’]+|\b[A-ZÀ-Þ][^\W\d_]+(?=[’'])")
_NUMBER = re.compile(r"\d[\d.,]*")


#: Phrases of headlines that nobody has written yet, for weak labels as well.
UNWRITTEN = re.compile(r"goes here|working title|untitled|\b(title|headline|titre|titel|überschrift|título|titolo|заголовок)\b.*\b(here|ici|hier|aquí|aqui|qui|здесь)\b|sans titre|sin título|ohne titel|見出し|タイトル", re.I)


def masked(unit: str, names: bool = True) -> str:
    unit = unit.strip().rstrip(".!…")
    if names and not unit.isupper():
        unit = _NAME.sub("Nn", unit)
    return _NUMBER.sub("0", unit).lower()


def _hash(x: str) -> int:
    return zlib.crc32(x.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def unit_features(unit: str, total: int, title: bool, names: bool = True) -> np.ndarray:
    """Slots of the features of a unit, given the length of its whole text."""
    return _features(masked(unit, names), total, title)


_TOKEN = re.compile(r"\w+|[^\w\s]")


def _features(m: str, total: int, title: bool) -> np.ndarray:
    words = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in _TOKEN.findall(m)], np.uint64)
    parts = [words * _SPREAD >> _SHIFT]
    if len(words) > 1:
        parts.append((words[:-1] * np.uint64(31_337) + words[1:] + np.uint64(1)) * _SPREAD >> _SHIFT)
    if len(m) >= 4:
        p = np.frombuffer(m.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = ((p[:-3] * np.uint64(31_337) + p[1:-2]) * np.uint64(31_337) + p[2:-1]) * np.uint64(31_337) + p[3:]
        parts.append(h * _SPREAD >> _SHIFT)
    few = [_hash(f"l {min(len(m) // 25, 6)}"), _hash(f"t {title}"), _hash(f"n {title} {min(len(words), 8)}")]
    if not title:
        few.append(_hash(f"a {min(total.bit_length(), 12)}"))
    return np.unique(np.concatenate([*parts, np.array(few, np.uint64)])).astype(np.int64)


def expression_features(text: str, start: int, end: int) -> np.ndarray:
    """Slots of the features of a bracket expression in its place."""
    e = text[start:end]
    inside = re.sub(r"^\W+|\W+$", "", e.strip("_%@"))
    form = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", _NUMBER.sub("0", inside)))
    opening = re.match(r"\W*_*", e).group()[:2]
    low = f"^{_NUMBER.sub('0', inside).lower()}$"
    line = text[text.rfind("\n", 0, start) + 1 : (text.find("\n", end) + 1 or len(text) + 1) - 1]
    rest = _EXPRESSION.sub("", line).strip()
    left, right = text[start - 1 : start] or "^", text[end : end + 1] or "$"
    parts = [f"o {opening}", f"f {form[:12]}", f"i {low}", f"v {left}", f"r {right}", f"s {len(inside.split())}", f"x {opening} {form[:3]}", f"p {min(len(rest.split()), 4)}", f"y {left in '`’“' or right in '`'}"]
    parts += [f"c {low[k : k + 3]}" for k in range(len(low) - 2)]
    return np.unique(np.array([_hash(f"e {p}") for p in parts], np.int64))


class Linear:
    """L2-regularised logistic regression on binary hashed features, by AdaGrad."""

    def __init__(self):
        self.w = np.zeros(1 << BITS, np.float32)
        self.b = 0.0

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, *, epochs: int = 5, l2: float = 2e-6, rate: float = 0.25, seed: int = 1) -> Linear:
        rng = np.random.default_rng(seed)
        grad = np.full(1 << BITS, 1e-3, np.float32)
        gb = 1e-3
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for s in range(0, len(order), 128):
                part = order[s : s + 128]
                n = np.array([len(rows[i]) for i in part])
                flat = np.concatenate([rows[i] for i in part])
                z = np.add.reduceat(self.w[flat], np.cumsum(n) - n) + self.b
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part]
                used, at = np.unique(flat, return_inverse=True)
                g = np.bincount(at, weights=np.repeat(err, n)).astype(np.float32) / len(part) ** 0.5 + l2 * len(rows) ** 0.5 * self.w[used]
                grad[used] += g * g
                self.w[used] -= rate * g / np.sqrt(grad[used])
                gb += err.sum() ** 2 / len(part)
                self.b -= rate * err.sum() / len(part) ** 0.5 / gb**0.5
        return self

    def score(self, features: np.ndarray) -> float:
        return float(self.w[features].sum() + self.b)


def units(text: str) -> list[str]:
    """Lines and sentences of a text; pieces without a sentence's end stay with their line."""
    return [text[s:e].strip() for s, e in sentences(text)]


class Judge:
    def __init__(self):
        self.unit, self.expression, self.trained = Linear(), Linear(), False
        self.known: dict = {}

    def unit_score(self, unit: str, total: int, title: bool = False) -> float:
        m = masked(unit)
        key = (m, total.bit_length(), title)
        x = self.known.get(key)
        if x is None:
            if len(self.known) > 100_000:
                self.known.clear()
            x = self.known[key] = self.unit.score(_features(m, total, title))
        return x

    def share(self, text: str) -> float:
        """The share of the text, in characters, that is residue."""
        us = units(text)
        size = np.array([len(u) for u in us])
        bad = np.array([self.unit_score(u, len(text)) > 0 for u in us])
        return float(size[bad].sum() / max(1, size.sum())) if us else 0.0

    def placeholder(self, text: str) -> bool:
        return any(self.expression.score(expression_features(text, *m.span())) > 0 for m in _EXPRESSION.finditer(text) if re.search(r"\w", m.group()))

    def reasons(self, title: str | None, text: str | None) -> list[str]:
        """Why a record is a case; empty if it is none."""
        if not self.trained or not text or not text.strip():
            return []
        out = []
        if self.placeholder(text) or title and self.placeholder(title):
            out.append("placeholder")
        if self.share(text) > 0.5:
            out.append("text")
        # a title of question marks is lost text, not residue
        if title and title.strip() and title.count("?") < 4 and self.unit_score(title, 0, True) > 0:
            out.append("title")
        return out


def _stock(records: list[tuple], hosts: int = 3) -> set[str]:
    """Units that short texts of several hosts have word for word, without a name: nobody reports the same thing so."""
    where: dict[str, set] = {}
    for host, _, _, text in records:
        if len(text) < SHORT:
            for u in units(text):
                if len(u) < 120 and not re.search(r"[^\W\d_][^.!?]*? [A-ZÀ-ÞА-Я][^\W\d_A-ZÀ-ÞА-Я]", u):
                    where.setdefault(_NUMBER.sub("0", u), set()).add(host)
    return {u for u, h in where.items() if len(h) >= hosts}


def _weak(records: list[tuple]) -> list[int | None]:
    """A first label for the text of each (host, http_status, title, text): 1 residue, 0 reporting, None undecided."""
    out: list[int | None] = []
    stock = _stock(records)
    for _, code, _, text in records:
        us = units(text)
        size = sum(map(len, us)) or 1
        seeded = sum(len(u) for u in us if SEEDS.search(u) or len(text) < SHORT and _NUMBER.sub("0", u) in stock) / size
        if len(text) < SHORT and (seeded > 0 and (code or 200) >= 400) or seeded > 0.6:
            out.append(1)
        elif len(text) >= SHORT and (code or 200) < 400 and seeded < 0.25 or seeded == 0 and (code or 200) < 400:
            out.append(0)
        else:
            out.append(None)
    return out


def _inside(e: str) -> str:
    return _NUMBER.sub("0", re.sub(r"^\W+|\W+$", "", e.strip("_%@"))).lower()


def fit(records: list[tuple[str | None, int | None, str | None, str | None]], *, rounds: int = 2, held_out_hosts: float = 0.2) -> tuple[Judge, dict]:
    """From (host, http_status, title, text): a judge, and its figures on hosts that were held out."""
    judge = Judge()
    rows = [r for r in records if r[3] and r[3].strip()]
    held = [zlib.crc32(str(r[0]).encode()) % 100 < 100 * held_out_hosts for r in rows]
    labels = _weak(rows)
    first = list(labels)
    train = [i for i, h in enumerate(held) if not h]
    if not any(labels[i] == 1 for i in train) or not any(labels[i] == 0 for i in train):
        return judge, {"rows": len(rows)}
    for turn in range(rounds):
        feats: dict[tuple, list] = {}
        page = {masked(u) for i in train if labels[i] == 1 and not _EXPRESSION.search(rows[i][3]) for u in units(rows[i][3])}
        real = {masked(u) for i in train if labels[i] == 0 for u in units(rows[i][3])}
        for i in train:
            _, _, title, text = rows[i]
            if labels[i] is None:
                continue
            for u in units(text):
                k = (masked(u), min(len(text).bit_length(), 12), False)
                feats.setdefault(k, [u, len(text), 0, 0])[2 + labels[i]] += 1
            if title and title.strip():
                # the headline over a residue page is mostly a real one
                m = masked(title)
                unwritten = UNWRITTEN.search(title) and len(title) < 45 and (title.isupper() or not re.search(r"\b[A-ZÀ-ÞА-Я][^\W\d_A-ZÀ-ÞА-Я]", title.lstrip("[('\"")[1:]))
                y = 1 if m in page - real or unwritten or not re.search(r"[^\W\d_]{3}", title) and labels[i] == 1 else 0
                if y or labels[i] == 0:
                    feats.setdefault((m, 0, True), [title, 0, 0, 0])[2 + y] += 1
                if not y and labels[i] == 0 and i % 4 == 0:  # as a headline in capitals looks
                    feats.setdefault((masked(title, False), 0, True, False), [title, 0, 0, 0])[2] += 1
        vectors = [unit_features(v[0], v[1], k[2], len(k) < 4) for k, v in feats.items()]
        y = np.array([v[3] / (v[2] + v[3]) for v in feats.values()], np.float32)
        weight = np.array([min(3.0, 1 + np.log(v[2] + v[3])) for v in feats.values()], np.float32)
        weight *= np.where(y > 0.5, max(1.0, 0.3 * (y <= 0.5).sum() / max(1, (y > 0.5).sum())), 1.0)
        judge.unit, judge.known, judge.trained = Linear().fit(vectors, y, weight), {}, True
        if turn + 1 < rounds:
            for i in train:
                s = judge.share(rows[i][3])
                # what was undecided at first becomes reporting only if it is long
                labels[i] = 1 if s > 0.7 or first[i] == 1 else 0 if s < 0.3 and (first[i] == 0 or len(rows[i][3]) >= SHORT) else None
    # expressions: an inside that stands alone somewhere is a placeholder's
    found = []
    alone: set[str] = set()
    for i in train:
        for text in (rows[i][2] or "", rows[i][3]):
            for m in _EXPRESSION.finditer(text):
                if not re.search(r"\w", m.group()):
                    continue
                line = text[text.rfind("\n", 0, m.start()) + 1 : (text.find("\n", m.end()) + 1 or len(text) + 1) - 1]
                rest = _EXPRESSION.sub("", line).strip(" |:,-–")
                lonely = len(rest.split()) <= 1 and text[m.start() - 1 : m.start()] != "`"
                if lonely:
                    alone.add(_inside(m.group()))
                found.append((text, m.start(), m.end(), lonely))
    if found:
        vectors = [expression_features(t, a, b) for t, a, b, _ in found]
        y = np.array([float(lone or _inside(t[a:b]) in alone and t[a - 1 : a] != "`") for t, a, b, lone in found], np.float32)
        judge.expression.fit(vectors, y, np.ones(len(y), np.float32), epochs=12)
    test = [i for i, h in enumerate(held) if h and first[i] is not None]
    guess = [judge.share(rows[i][3]) > 0.5 for i in test]
    truth = [first[i] == 1 for i in test]
    judge.known = {}
    return judge, {"rows": len(rows), "held_out": len(test), "unlike_weak_label": sum(g != t for g, t in zip(guess, truth, strict=True)), "expressions": len(found)}


def trained(rows: DataFrame, *, training_rows: int = TRAINING_ROWS, training_chars: int = TRAINING_CHARS) -> tuple[Judge, dict]:
    """Fits on at most ``training_rows`` rows of (id, host, http_status, title, text) with a text, the first ``training_chars`` characters of each."""
    got = sample(rows.where("text is not null and text <> ''"), "id", training_rows, {"text": training_chars, "title": 400})
    return fit([(r.host, r.http_status, r.title, r.text) for r in got])


def _marked(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for whole in batches:
            for b in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                why = [judge.reasons(t, x) for t, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                row = [i for i, w in enumerate(why) if w]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array([why[i] for i in row], pa.list_(pa.string()))], names=["id", "reasons"])

    return run


def excluded(rows: DataFrame, judge: Judge) -> DataFrame:
    """From (id, title, text): id and reasons (placeholder, text, title) of the records to exclude."""
    shared = rows.sparkSession.sparkContext.broadcast(judge)
    return rows.select("id", "title", "text").mapInArrow(_marked(shared), f"id {rows.schema['id'].dataType.simpleString()}, reasons array<string>")


def _excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "article_texts").select("id", "host", "http_status", "title", "text")
    return excluded(spread(rows), trained(rows)[0])


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p5_found: the article_texts records that hold residue in place of reporting."""
    return _excluded(spark, sf_dir).select("id")


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p5_reasons: the excluded records with the reasons."""
    return _excluded(spark, sf_dir)


QUERIES = {"p5_found": found, "p5_reasons": reasons}
SQL: dict[str, str] = {}
