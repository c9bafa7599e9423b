"""Text that was decoded with the wrong encoding: finding it and, where possible, restoring it.

A character n-gram model is trained on all clean records: those in which no passage can be read as the
outcome of a chain of encode and decode steps on known characters. In every other text, each run of characters beyond ASCII is encoded and
decoded again by each chain that is valid for it (up to three steps, for text garbled more than once), and the
likeliest reading wins if it is likelier than the text as it stands by more than a margin. The margins, one for each kind
of passage, are those that tell garbled from clean best on held-out clean records, one in six of all, and garbled copies of them. Passages that were destroyed (question
marks or replacement signs in place of characters) are found in the same way, the likeliest characters filled in, but are not
restored.

Every text is read whole; runs and words are judged once for each context in a task. A pure map after training.

Defined cases: null and empty texts are clean; HTML entities and URLs are left alone; with no clean record to train on,
every reading is unlikely and nothing is found but replacement signs; repeated rows and extra columns are treated alike.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread, table

ORDER = 4
#: One clean record in so many is held out, with a spoilt copy of it.
HELD = 6
LOST = "�"
#: Single-byte readings of UTF-8 bytes, and encodings of one alphabet that are taken for one another.
READ_AS = ["cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1251", "koi8_r", "cp866", "mac_cyrillic", "cp1250", "cp1254", "iso8859_2", "cp932", "gbk", "big5"]
CYRILLIC = ["cp1251", "koi8_r", "cp866", "mac_cyrillic", "iso8859_5"]
LATIN = ["cp1252", "latin-1", "mac_roman", "cp850", "cp437"]
EAST = ["cp932", "euc_jp", "gb18030", "big5"]

_RUN = re.compile(r"[^\x00-\x7f]+")
_URL = re.compile(r"https?://[^\s\"'<>]*|&#?\w+;")
_MARKS = re.compile(r"\?+")
_DOUBTFUL = re.compile(r"\w\?\w|\?\?|[>,] ?\?\w")


_CONTROLS = re.compile("[\x80-\x9f]")
#: Bytes beyond ASCII that each of the Windows code pages defines.
_DEFINED = {c: bytes(b for b in range(128, 256) if bytes([b]).decode(c, "ignore")) for c in (*READ_AS, *CYRILLIC) if c.startswith("cp125")}


def encode(text: str, codec: str) -> bytes:
    """As ``str.encode``, but bytes that Windows code pages leave undefined pass as control characters."""
    if codec.startswith("cp125") and _CONTROLS.search(text):
        return b"".join(bytes([ord(c)]) if 0x80 <= ord(c) < 0xA0 else c.encode(codec) for c in text)
    return text.encode(codec)


def decode(data: bytes, codec: str) -> str:
    if codec.startswith("cp125") and not data.translate(None, _DEFINED[codec]).isascii():
        return "".join(chr(b) if 0x80 <= b < 0xA0 and bytes([b]).decode(codec, "ignore") == "" else bytes([b]).decode(codec) for b in data)
    return data.decode(codec)


def _steps(run: str) -> Iterator[tuple[str, str, str]]:
    for a in READ_AS:
        try:
            out = encode(run, a).decode("utf-8")
        except (UnicodeError, ValueError):
            continue
        if out != run:
            yield a, "utf-8", out


def _swaps(run: str) -> Iterator[tuple[str, str, str]]:
    """Readings of a whole word beyond ASCII in which a letter always becomes another letter."""
    cyrillic = "\u0400" <= run[0] <= "\u04ff"
    for a in CYRILLIC if cyrillic else LATIN:
        for b in CYRILLIC + ([] if cyrillic else EAST):
            if a != b:
                try:
                    out = decode(encode(run, a), b)
                except (UnicodeError, ValueError):
                    continue
                if out != run:
                    yield a, b, out


def readings(run: str, depth: int = 3) -> dict[str, tuple[str, ...]]:
    """Every text that some chain of readings as UTF-8 makes of ``run``, with the shortest such chain."""
    out: dict[str, tuple[str, ...]] = {}
    front = {run: ()}
    for _ in range(depth):
        nxt = {}
        for text, chain in front.items():
            for a, b, new in _steps(text):
                if new not in out and new != run and new not in nxt and "\x00" not in new:
                    nxt[new] = (*chain, f"{a}>{b}")
        out |= nxt
        front = {t: c for t, c in nxt.items() if not t.isascii()}
        if not front:
            break
    return out


def grams(texts: Iterable[str], chars: int = 4_000_000) -> Iterator[tuple[list[str], np.ndarray]]:
    """The n-grams of the model's order in the texts, with their counts, by and by: one that comes again is to be added up."""

    def counted(part: list[str]) -> tuple[list[str], np.ndarray]:
        a = np.frombuffer("".join(part).encode("utf-16-le"), np.uint16).astype(np.uint64)
        key = a[:-3] << np.uint64(48) | a[1:-2] << np.uint64(32) | a[2:-1] << np.uint64(16) | a[3:]
        # what begins before a text ends in its first signs; only what reaches from one text into the next is none
        first = np.cumsum([0, *map(len, part[:-1])])
        inner = np.ones(len(key), bool)
        for k in range(1, ORDER):
            inner[first[1:] - k] = False
        key, n = np.unique(key[inner], return_counts=True)
        signs = key.astype(">u8").tobytes().decode("utf-16-be")
        return [signs[i : i + ORDER] for i in range(0, len(signs), ORDER)], n

    part, size = [], 0
    for t in texts:
        t = "\n" * (ORDER - 1) + t + "\n"
        if max(t) > "\uffff":
            got = Counter(t[i : i + ORDER] for i in range(len(t) - ORDER + 1))
            yield list(got), np.array(list(got.values()))
            continue
        part.append(t)
        size += len(t)
        if size > chars:
            yield counted(part)
            part, size = [], 0
    if part:
        yield counted(part)


class CharModel:
    """Witten-Bell smoothed character n-gram model, from the counts of n-grams of its order."""

    def __init__(self, whole: Iterable[tuple[str, int]], order: int = ORDER):
        self.order = order
        counts: Counter = Counter()
        for gram, v in whole:
            for n in range(1, order + 1):
                counts[gram[order - n :]] += v
        self.total = sum(v for k, v in counts.items() if len(k) == 1)
        self.seen: dict[str, int] = {}
        self.kinds: dict[str, int] = {}
        for k, v in counts.items():
            if len(k) > 1:
                self.seen[k[:-1]] = self.seen.get(k[:-1], 0) + v
                self.kinds[k[:-1]] = self.kinds.get(k[:-1], 0) + 1
        self.counts = {k: v for k, v in counts.items() if v > 1 or len(k) < 3}
        beyond = Counter({k: v for k, v in counts.items() if len(k) == 1 and ord(k) > 127})
        self.alphabet = [k for k, v in sorted(beyond.items(), key=lambda x: (-x[1], x[0]))[:120] if v > 1 and not "぀" <= k <= "鿿"]
        self.known: dict[str, float] = {}

    def _p(self, gram: str) -> float:
        if gram == "":
            return 1 / 20_000
        p = self._p(gram[1:]) if len(gram) > 1 else 1 / 20_000
        h = gram[:-1]
        if len(gram) == 1:
            return (self.counts.get(gram, 0) + 50 * p) / (self.total + 50)
        n = self.seen.get(h, 0)
        if not n:
            return p
        t = self.kinds[h]
        return (self.counts.get(gram, 0) + t * p) / (n + t)

    def logp(self, gram: str) -> float:
        x = self.known.get(gram)
        if x is None:
            if len(self.known) > 300_000:
                self.known.clear()
            x = self.known[gram] = math.log(self._p(gram))
        return x

    def score(self, left: str, text: str, right: str) -> float:
        """Log-likelihood of ``text`` after ``left`` and of the begin of ``right`` after both."""
        s, n = left + text + right, self.order
        return sum(self.logp(s[max(0, i - n + 1) : i + 1]) for i in range(len(left), len(s)))


#: Kinds of passages, each with its own margin: bytes of UTF-8, an alphabet taken for another, and question marks inside
#: words or in other places where no question ends, and between blanks. One where a question could end is no evidence.
KINDS = ("utf", "swap", "inside", "between")


class Repairer:
    """Finds garbled passages with a trained model and a margin for each kind."""

    def __init__(self, model: CharModel, margins: dict[str, float]):
        self.model, self.margins = model, margins
        self.of_run: dict = {}
        self.judged: dict = {}
        self.plain: set[str] = set()

    def _keep(self, where: dict, key, value):
        if len(where) > 200_000:
            where.clear()
        where[key] = value
        return value

    def _readings(self, run: str) -> tuple[dict, tuple[float, str, tuple[str, ...]]]:
        """Readings as UTF-8, and the likeliest as another alphabet (gain, text, chain)."""
        x = self.of_run.get(run)
        if x is None:
            swap = (0.0, run, ())
            if len(run) > 1 and run.isalpha():
                now = self.model.score(" ", run.lower(), " ")
                for a, b, text in _swaps(run):
                    swap = max(swap, (self.model.score(" ", text.lower(), " ") - now, text, (f"{a}>{b}",)))
            x = self._keep(self.of_run, run, (readings(run), swap))
        return x

    def _suspect(self, run: str) -> bool:
        if run in self.plain:
            return False
        options, swap = self._readings(run)
        if LOST in run or options or swap[0] > 0:
            return True
        if len(self.plain) > 300_000:
            self.plain.clear()
        self.plain.add(run)
        return False

    def _best(self, left: str, run: str, right: str, alone: bool) -> tuple[float, str, tuple[str, ...], str]:
        options, swap = self._readings(run)
        best = (*swap, "swap") if alone and swap[0] > 0 else (0.0, run, (), "utf")
        if options:
            key = (left, run, right)
            if (known := self.judged.get(key)) is None:
                now = self.model.score(left, run, right)
                known = self._keep(self.judged, key, (*max((self.model.score(left, t, right) - now, t, c) for t, c in options.items()), "utf"))
            best = max(best, known)
        return best

    def _filled(self, left: str, n: int, right: str) -> float:
        """How much likelier the likeliest characters are than n question marks."""
        key = (left, n, right)
        if (known := self.judged.get(key)) is not None:
            return known
        now, text = self.model.score(left, "?" * n, right), ""
        for i in range(min(n, 12)):
            r = right if i == n - 1 else ""
            text += max(self.model.alphabet, key=lambda c: self.model.score((left + text)[-3:], c, r), default="?")
        return self._keep(self.judged, key, self.model.score(left, text, right) - now) if len(text) == n else math.inf

    def passages(self, text: str) -> Iterator[tuple[int, int, float, str | None, str, str]]:
        """(start, end, gain, restored or None, chain, kind) of every passage that has a likelier reading."""
        suspects = set() if text.isascii() else {r for r in set(_RUN.findall(text)) if self._suspect(r)}
        marks = "?" in text
        if not suspects and not marks:
            return
        skip = [m.span() for m in _URL.finditer(text)] if ("&" in text or "://" in text) else []
        for m in _RUN.finditer(text) if suspects else ():
            run = m.group()
            if run not in suspects:
                continue
            a, b = m.span()
            if LOST in run:
                yield a, b, math.inf, None, "lost", "utf"
                continue
            if any(x <= a < y for x, y in skip):
                continue
            alone = (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())
            gain, new, chain, kind = self._best(text[max(0, a - 3) : a], run, text[b : b + 3], alone)
            if gain > 0:
                yield a, b, gain, new, " ".join(chain), kind
        for m in _MARKS.finditer(text) if marks else ():
            a, b = m.span()
            if not any(x <= a < y for x, y in skip) and (gain := self._filled(text[max(0, a - 3) : a], b - a, text[b : b + 3])) > 0:
                left, right = text[a - 1 : a], text[b : b + 1]
                if left == " " and right == " ":
                    yield a, b, gain, None, "lost", "between"
                elif right.isalnum() or b - a > 1 or left in ",;:>([":
                    yield a, b, gain, None, "lost", "inside"

    def _alphabet(self, words: set[str]) -> dict[str, tuple[str, str]]:
        """The readings of the words of one text by the chain that is likeliest for all of them."""
        read: dict[str, dict[str, str]] = {}
        for w in words:
            for a, b, text in _swaps(w):
                read.setdefault(f"{a}>{b}", {})[w] = text
        total = {c: sum(self.model.score(" ", x.get(w, w).lower(), " ") for w in words) for c, x in read.items()}
        best = max(total, key=total.get, default=None)
        return {w: (t, best) for w, t in read[best].items()} if best else {}

    def _counts(self, p: tuple) -> bool:
        return p[2] > self.margins[p[5]]

    def garbled(self, text: str | None) -> bool:
        return bool(text) and any(map(self._counts, self.passages(text)))

    def restored(self, text: str | None) -> tuple[str | None, bool, bool, str]:
        """(text with its passages restored, garbled, whether a passage is lost, chains)."""
        if not text:
            return text, False, False, ""
        out, at, lost, chains = [], 0, False, Counter()
        passages = sorted(filter(self._counts, self.passages(text)), key=lambda p: p[:2])
        swapped = self._alphabet({text[p[0] : p[1]] for p in passages if p[5] == "swap"})
        for a, b, _, new, chain, kind in passages:
            if a < at:
                continue
            if kind == "swap" and text[a:b] in swapped:
                new, chain = swapped[text[a:b]]
            chains[chain] += 1
            if new is None:
                lost = True
            else:
                out += [text[at:a], new]
                at = b
        return "".join([*out, text[at:]]), bool(chains), lost, ", ".join(c for c, _ in chains.most_common())


class Clean:
    """Tells clean records: those without a passage that some chain reads as characters which undoubted records hold."""

    def __init__(self, alphabet: set[str] | None = None):
        self.alphabet = alphabet
        self.read: dict[str, set[frozenset]] = {}

    def _readings(self, run: str) -> set[frozenset]:
        x = self.read.get(run)
        if x is None:
            if len(self.read) > 200_000:
                self.read.clear()
            x = self.read[run] = {frozenset(t) for t in readings(run)}
        return x

    @staticmethod
    def whole(t: str | None) -> bool:
        return bool(t) and LOST not in t and not ("?" in t and _DOUBTFUL.search(t))

    def undoubted(self, t: str | None) -> set[str]:
        """The characters beyond ASCII of a record of which no passage has another reading."""
        runs = set(_RUN.findall(t)) if self.whole(t) and not t.isascii() else ()
        return set().union(*runs) if runs and not any(map(self._readings, runs)) else set()

    def __call__(self, t: str | None) -> bool:
        return self.whole(t) and not (not t.isascii() and any(x <= self.alphabet for r in set(_RUN.findall(t)) for x in self._readings(r)))


ASCII = frozenset(map(chr, range(128)))


#: What wrong readings do to held-out clean text when the margin is validated.
SPOILERS = [*(("utf-8", a) for a in READ_AS[:7]), ("cp1251", "latin-1"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1252", "?"), ("cp1252", LOST)]


def spoilt(text: str, chain: tuple[str, str], twice: bool = False) -> str | None:
    """``text`` after a wrong reading; None if that leaves it as it was or is impossible."""
    a, b = chain
    try:
        if b in ("?", LOST):
            out = "".join(c if ord(c) < 128 else b for c in text)
        else:
            out = decode(encode(text, a), b)
            if twice:
                out = decode(encode(out, a), b)
    except (UnicodeError, ValueError):
        return None
    return out if out != text else None


def held_out(t: str) -> bool:
    return zlib.crc32(t.encode("utf-8", "replace")) % HELD == 0


def styles(t: str) -> list[str]:
    """A clean record as it is trained on; headlines in capitals are a style of their own that few records show."""
    return [t, t.upper()] if len(t) < 200 else [t]


def gains(probe: Repairer, t: str) -> dict[str, float]:
    out: dict[str, float] = {}
    for p in probe.passages(t):
        out[p[5]] = max(out.get(p[5], 0.0), min(p[2], 1e3))
    return out


def tried(probe: Repairer, t: str) -> Iterator[tuple[bool, dict[str, float]]]:
    """(whether spoilt, gains) of a clean record and of a spoilt copy of it."""
    rng = random.Random(zlib.crc32(t.encode("utf-8", "replace")))
    yield False, gains(probe, t)
    words = t.split(" ")
    if rng.random() < 0.6:  # one passage only
        k = rng.randrange(len(words))
        words = words[k : k + rng.randint(1, 12)]
    copy = " ".join(words)
    for chain in rng.sample(SPOILERS, len(SPOILERS)):  # the first that does anything to it
        if (x := spoilt(copy, chain, rng.random() < 0.2)) is not None:
            yield True, gains(probe, x)
            break


def evidence(found: Iterable[tuple[bool, dict[str, float]]]) -> Iterator[tuple[str, bool, float]]:
    """(kind, whether spoilt, gain) of what ``tried`` gives."""
    for bad, g in found:
        yield from ((kind, bad, v) for kind, v in g.items() if not bad or kind != "between" or len(g) == 1)


def margins_of(counts: dict[tuple[str, bool, float], int]) -> dict[str, float]:
    """The margin of each kind from how often gains come in clean and in spoilt records."""
    margins = {}
    for kind in KINDS:
        (x, nx), (y, ny) = (map(np.array, zip(*sorted((v, n) for (k, b, v), n in counts.items() if k == kind and b == bad), strict=True)) if any(k == kind and b == bad for k, b, _ in counts) else (np.zeros(0), np.zeros(0)) for bad in (False, True))
        options = np.unique(np.concatenate([[1.0], x + 1e-6, y[y < 1e3] - 1e-6]))
        upto = lambda v, n: np.r_[0, np.cumsum(n)][np.searchsorted(v, options, "right")]
        wrong = nx.sum() - upto(x, nx) + upto(y, ny) / max(1, ny.sum()) * max(1, nx.sum())
        among = options[wrong <= wrong.min() + 1e-9]
        # where held-out records leave it open, a likelihood ratio of e^10 decides
        margins[kind] = float(min(10.0, max(1.0, (among[0] + among[-1]) / 2)))
    return margins


def fit(records: list[str]) -> tuple[CharModel, dict[str, float], dict]:
    """Model, margins, and how many held-out clean and garbled records they judge wrongly."""
    clean = Clean()
    clean.alphabet = ASCII.union(*map(clean.undoubted, records))
    good = [t for t in records if clean(t)]
    model = CharModel((g, int(n)) for gs, ns in grams(x for t in good if not held_out(t) for x in styles(t)) for g, n in zip(gs, ns, strict=True))
    probe = Repairer(model, dict.fromkeys(KINDS, 0.0))
    found = [x for t in good if held_out(t) for x in tried(probe, t)]
    margins = margins_of(Counter(evidence(found)))
    hits = [[any(v > margins[k] for k, v in g.items()) for bad, g in found if bad == b] for b in (False, True)]
    return model, margins, {"held_out_clean": len(hits[0]), "false": sum(hits[0]), "held_out_garbled": len(hits[1]), "missed": len(hits[1]) - sum(hits[1])}


def _each(columns: int, per_task, schema: list[tuple[str, pa.DataType]]):
    """Every text of the columns through ``per_task(texts)``, which yields rows in columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for b in batches for k in range(columns) for t in b.column(k).to_pylist() if t)
        for cols in per_task(texts):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema, strict=True)], names=[n for n, _ in schema])

    return run


def _signs(texts: Iterator[str]):
    clean = Clean()
    found = set().union(*map(clean.undoubted, texts))
    yield (sorted(found),)


def _grams(shared):
    def of(texts: Iterator[str]):
        clean = Clean(shared.value)
        yield from grams(x for t in texts if not held_out(t) and clean(t) for x in styles(t))

    return of


def _tried(shared):
    def of(texts: Iterator[str]):
        alphabet, model = shared.value
        clean, probe = Clean(alphabet), Repairer(model, dict.fromkeys(KINDS, 0.0))
        # to a hundredth, so that what is counted is bounded
        counts = Counter((k, b, round(v, 2)) for t in texts if held_out(t) and clean(t) for k, b, v in evidence(tried(probe, t)))
        keys = list(counts)
        yield [k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], list(counts.values())

    return of


def trained(rows: DataFrame, columns: list[str]) -> tuple[CharModel, dict[str, float]]:
    """Model and margins from all texts of the columns, as ``fit`` makes them.

    What reaches the driver is the alphabet, the distinct n-grams with their counts, and counts of gains by kind and hundredth.
    """
    rows, context = spread(rows.select(*columns)), rows.sparkSession.sparkContext
    signs = rows.mapInArrow(_each(len(columns), _signs, [("sign", pa.string())]), "sign string").distinct().collect()
    alphabet = ASCII.union(r.sign for r in signs)
    counted = rows.mapInArrow(_each(len(columns), _grams(context.broadcast(alphabet)), [("gram", pa.string()), ("n", pa.int64())]), "gram string, n bigint")
    model = CharModel((r.gram, r.n) for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).toLocalIterator())
    gained = rows.mapInArrow(_each(len(columns), _tried(context.broadcast((alphabet, model))), [("kind", pa.string()), ("bad", pa.bool_()), ("gain", pa.float64()), ("n", pa.int64())]), "kind string, bad boolean, gain double, n bigint")
    got = gained.groupBy("kind", "bad", "gain").agg(F.sum("n").alias("n")).collect()
    model.known.clear()
    return model, margins_of({(r.kind, r.bad, r.gain): r.n for r in got})


def _judge(shared, columns: list[str], full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(*shared.value)
        for whole in batches:
            for b in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                row, field, text, lost, chains = [], [], [], [], []
                for k, c in enumerate(columns, 1):
                    for i, t in enumerate(b.column(k).to_pylist()):
                        if full:
                            new, found, gone, chain = repairer.restored(t)
                        else:
                            found = repairer.garbled(t)
                        if found:
                            row.append(i)
                            field.append(c)
                            if full:
                                text.append(new)
                                lost.append(gone)
                                chains.append(chain)
                cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(field, pa.string())]
                names = ["id", "field_name"]
                if full:
                    cols += [pa.array(text, pa.string()), pa.array(lost, pa.bool_()), pa.array(chains, pa.string())]
                    names += ["restored", "partly_lost", "chains"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def garbled(rows: DataFrame, key: str, columns: list[str], model: CharModel, margins: dict[str, float], *, full: bool = False) -> DataFrame:
    """id and field_name of the garbled fields; with ``full`` also restored, partly_lost and chains."""
    rows = rows.select(F.col(key).alias("id"), *columns)
    model.known.clear()
    shared = rows.sparkSession.sparkContext.broadcast((model, margins))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, field_name string" + ", restored string, partly_lost boolean, chains string" * full
    return rows.mapInArrow(_judge(shared, columns, full), schema)


def _run(spark: SparkSession, sf_dir: str, full: bool) -> DataFrame:
    rows = table(spark, sf_dir, "raw_items").select("id", "title", "body")
    model, margins = trained(rows, ["title", "body"])
    return garbled(spread(rows), "id", ["title", "body"], model, margins, full=full)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p4_found: the fields of raw_items with a garbled or destroyed passage."""
    return _run(spark, sf_dir, False)


def restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p4_restored: the garbled fields with their text restored as far as it is not lost, and the chains that undo it."""
    return _run(spark, sf_dir, True)


QUERIES = {"p4_found": found, "p4_restored": restored}
SQL: dict[str, str] = {}
