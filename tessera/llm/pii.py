"""Personal data: patterns, and a character-level bidirectional LSTM with CRF
transitions that adds spans the patterns miss.

The network is trained in numpy from labelled spans.  It reads overlapping windows
of the text; each window decides the tags of its own middle part, so that the tags
of a text are one sequence, and spans are read off that.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import row_pieces, sample_texts, utf8

KINDS = ("email", "ip", "card", "phone")
WINDOW, OWN = 96, 48         # characters of a window, and of the part in its middle that it decides
HIDDEN = 16
TRAIN_DOCS = 300             # most documents that the network is trained on
TRAIN_WINDOWS = 768
TRAIN_SPANS, TRAIN_DECOYS = 8, 4     # most spans, and most other numbers, that a text gives, drawn from all of it
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
_CLASSES = 133
_BATCH = 512                 # windows decoded together
_TEXT = 1 << 21

# Fixed patterns of the contract.  Look-behind and possessive quantifiers only
# keep long runs of digits from being tried again from every digit.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
# What any span of the four kinds must hold: a digit, or a sign for "at".
_TRIGGER = re.compile(r"[\d@＠]|[\[({]\s?at\s?[\])}]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
            at = text.find("@", end)
        else:
            end, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the patterns' matches that hold, by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def plausible(kind: int, text: str) -> bool:
    """What a span that the network adds must hold to count."""
    d = _digits(text)
    if kind == 0:
        return bool(re.search(r"[@＠]|[\[({]\s?at\s?[\])}]", text)) and bool(re.search(r"\w\W{0,3}\.|\.\w|dot", text))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and "." in text
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d) and len(d) * 2 >= len(text)
    return 9 <= len(d) <= 15 and len(d) * 2 >= len(text) and text.lstrip()[:1] in "+(0"


# -- network -----------------------------------------------------------------

_TABLE = np.zeros(256, np.int64)
_TABLE[:128] = np.arange(1, 129)


def char_classes(text: str) -> np.ndarray:
    """ASCII characters are themselves; others are letters, digits, blanks or signs; 0 is padding."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(codes < 128, codes + 1, 129).astype(np.int64)
    for i in np.flatnonzero(codes >= 128).tolist():
        c = chr(codes[i])
        out[i] = 129 if c.isalpha() else 130 if c.isdecimal() else 131 if c.isspace() else 132
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _log_sum(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Tags: 0 outside, 2k + 1 the first and 2k + 2 a further character of kind k."""

    def __init__(self, seed: int = 11, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        tags = 1 + 2 * len(KINDS)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (_CLASSES, 4 * hidden))
            self.p["h" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden:2 * hidden] = 1.0          # remember at first
            self.p["c" + d] = bias
        self.p["o"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, tags))
        self.p["ob"] = np.zeros(tags)
        self.p["t"] = rng.normal(0, 0.1, (tags, tags))
        self.p["s"] = np.zeros(tags)

    def _run(self, x, d, keep=False):
        """Hidden states (T, N, H) in reading order of direction ``d``."""
        H, p = self.h, self.p
        n, steps = x.shape
        h, c = np.zeros((n, H), p["o"].dtype), np.zeros((n, H), p["o"].dtype)
        out, tape = np.zeros((steps, n, H), p["o"].dtype), []
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            z = p["x" + d][x[:, t]] + h @ p["h" + d] + p["c" + d]
            gates = _sigmoid(z[:, :3 * H])
            i, f, o = gates[:, :H], gates[:, H:2 * H], gates[:, 2 * H:]
            g = np.tanh(z[:, 3 * H:])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            h2 = o * tc
            if keep:
                tape.append((t, h, c, i, f, o, g, tc))
            h, c = h2, c2
            out[t] = h
        return out, tape

    def _back(self, x, d, tape, dout, grads):
        H, p = self.h, self.p
        dh, dc, all_dz = np.zeros_like(dout[0]), np.zeros_like(dout[0]), []
        for t, h, c, i, f, o, g, tc in reversed(tape):
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            all_dz.append(dz)
            grads["h" + d] += h.T @ dz
            grads["c" + d] += dz.sum(0)
            dh, dc = dz @ p["h" + d].T, dc * f
        read = np.concatenate([x[:, step[0]] for step in reversed(tape)])
        order = np.argsort(read, kind="stable")
        classes, first = np.unique(read[order], return_index=True)
        grads["x" + d][classes] += np.add.reduceat(np.concatenate(all_dz)[order], first, axis=0)

    def emissions(self, x, keep=False):
        hf, tf = self._run(x, "f", keep)
        hb, tb = self._run(x, "b", keep)
        both = np.concatenate([hf, hb], 2)
        return both @ self.p["o"] + self.p["ob"], both, tf, tb

    def loss(self, x, y):
        """(mean negative log likelihood of the tag sequences, gradients)."""
        e, both, tf, tb = self.emissions(x, True)
        steps, n, k = e.shape
        t_, s_ = self.p["t"], self.p["s"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = s_ + e[0]
        for t in range(1, steps):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + t_, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(t_ + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _log_sum(alpha[-1], 1)
        yt = y.T
        rows = np.arange(n)
        gold = s_[yt[0]] + e[0, rows, yt[0]]
        grads = {name: np.zeros_like(v) for name, v in self.p.items()}
        de = np.exp(alpha + beta - z[None, :, None])
        grads["s"] = de[0].sum(0) - np.bincount(yt[0], minlength=k)
        for t in range(1, steps):
            gold = gold + t_[yt[t - 1], yt[t]] + e[t, rows, yt[t]]
            pair = np.exp(alpha[t - 1][:, :, None] + t_ + (e[t] + beta[t])[:, None, :] - z[:, None, None])
            grads["t"] += pair.sum(0)
            np.add.at(grads["t"], (yt[t - 1], yt[t]), -1.0)
        de[np.arange(steps)[:, None], rows[None, :], yt] -= 1.0
        grads["o"] = np.einsum("tnh,tnk->hk", both, de)
        grads["ob"] = de.sum((0, 1))
        dboth = de @ self.p["o"].T
        self._back(x, "f", tf, dboth[:, :, :self.h], grads)
        self._back(x, "b", tb, dboth[:, :, self.h:], grads)
        return (z - gold).mean(), {name: g / n for name, g in grads.items()}

    def fit(self, x, y, epochs: int = 10, batch: int = 48, rate: float = 0.02, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(order), batch):
                _, grads = self.loss(x[order[i:i + batch]], y[order[i:i + batch]])
                norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
                step += 1
                lr = rate * (1 - 0.8 * epoch / epochs)
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def decode(self, x) -> np.ndarray:
        """Viterbi tags (N, T)."""
        e = self.emissions(x)[0]
        steps, n, k = e.shape
        back = np.zeros((steps, n, k), np.int8)
        v = self.p["s"] + e[0]
        for t in range(1, steps):
            total = v[:, :, None] + self.p["t"]
            back[t] = total.argmax(1)
            v = total.max(1) + e[t]
        tags = np.zeros((n, steps), np.int8)
        tags[:, -1] = v.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags


# -- training ----------------------------------------------------------------

def _invent(rng) -> tuple[int, str]:
    """A made-up value of a kind, in writings that patterns may or may not cover."""
    kind = int(rng.integers(len(KINDS)))
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(2, 9))))
    if kind == 0:
        at = str(rng.choice(["@", "@", "@", " @ ", " [at] ", "(at)"]))
        return 0, word() + str(rng.choice([".", "_", ""])) + (word() if rng.random() < 0.5 else digits(2)) + at + word() + str(rng.choice([".com", ".example.org", ".net", ".co.uk"]))
    if kind == 1:
        return 1, ".".join(str(v) for v in rng.integers(0, 256, 4))
    if kind == 2:
        d = digits(int(rng.choice([13, 15, 16, 16, 16, 19])))
        gap = str(rng.choice(["", "", " ", "-", "."]))
        return 2, gap.join(d[i:i + 4] for i in range(0, len(d), 4))
    a, b, c = digits(3), digits(3), digits(4)
    return 3, str(rng.choice([f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"+{digits(2)} {a} {b}{c}", f"({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"+{digits(11)}"]))


def _decoy(rng) -> str:
    """Numbers and signs that are no personal data."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    hexes = "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 40))
    return str(rng.choice([digits(2), digits(4), digits(6), f"{digits(1)}.{digits(2)}", f"{digits(4)}-{digits(2)}-{digits(2)}", f"v{digits(1)}.{digits(1)}.{digits(1)}",
                           f"{digits(2)}:{digits(2)}", f"{digits(3)},{digits(3)}", "@", "user@", f'token = "{hexes}"', f"#{digits(5)}"]))


def _some(rng, items: list, most: int) -> list:
    """At most ``most`` of the items, any of them as likely, in their order."""
    return items if len(items) <= most else [items[i] for i in sorted(rng.choice(len(items), most, replace=False))]


def training_windows(texts: list[str], most: int = TRAIN_WINDOWS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: surroundings of the patterns' matches in ``texts``, one half
    with the value replaced by an invented one, and as many with decoys."""
    rng, pick = np.random.default_rng(seed), np.random.default_rng(seed + 1)
    contexts = []
    for text in texts:
        spans = base_spans(text)
        for a, kind, b in _some(pick, spans, TRAIN_SPANS):
            if b - a < WINDOW // 2 and not any(x[0] < b and a < x[2] for x in spans if x != (a, kind, b)):
                contexts.append((text[max(0, a - WINDOW):a], kind, text[a:b], text[b:b + WINDOW]))
        for m in _some(pick, [m for m in re.finditer(r"[^\s]+", text) if _MARK.search(m[0])], TRAIN_DECOYS):
            if not any(x[0] < m.end() and m.start() < x[2] for x in spans):
                contexts.append((text[max(0, m.start() - WINDOW):m.start()], -1, m[0][:WINDOW], text[m.end():m.end() + WINDOW]))
    if not contexts:
        contexts = [("some words before ", -1, "12", " and after it.")]
    x, y = np.zeros((most, WINDOW), np.int64), np.zeros((most, WINDOW), np.int64)
    for n in range(most):
        left, kind, value, right = contexts[int(rng.integers(len(contexts)))]
        draw = rng.random()
        if draw < 0.4:
            kind, value = _invent(rng)
        elif draw < 0.65:
            kind, value = -1, _decoy(rng)
        # No other value may stand beside the one that is labelled.
        left, right = _TRIGGER.sub("x", left), _TRIGGER.sub("x", right)
        shift = int(rng.integers(0, max(1, WINDOW - min(WINDOW - 1, len(value)))))
        left = left[len(left) - min(shift, len(left)):]
        text = (left + value + right)[:WINDOW]
        x[n, :len(text)] = char_classes(text)
        if kind >= 0:
            a, b = len(left), min(WINDOW, len(left) + len(value))
            y[n, a:b] = 2 * kind + 2
            y[n, a] = 2 * kind + 1
    return x, y


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Tagger:
    """Trained in one task on the surroundings of pattern matches in at most
    ``most`` documents with a digit or an at sign, those of least id hash."""
    sample = sample_texts(docs.filter(F.col(text_col).rlike("[0-9@]")), id_col, text_col, most, 23)

    def run(batches):
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        tagger = Tagger().fit(*training_windows(texts))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tagger.p)])], ["p"])

    tagger = Tagger()
    for row in sample.repartition(1).mapInArrow(run, "p binary").collect():
        tagger.p = pickle.loads(row["p"])
    return tagger


# -- finding -----------------------------------------------------------------

def network_tags(tagger: Tagger, texts: list[str]) -> list[dict[int, int]]:
    """{position: tag} for each text, outside ones left out.  Windows overlap by
    half; each decides its own middle (the first and last also the ends).  A
    window without a digit or an at sign can hold no span and is all outside."""
    edge = (WINDOW - OWN) // 2
    where, rows = [], []
    for k, text in enumerate(texts):
        if not _TRIGGER.search(text):
            continue
        classes = None
        starts = set()
        for m in _TRIGGER.finditer(text):
            first = max(0, (m.start() - WINDOW + 1 + OWN - 1) // OWN)
            starts.update(range(first * OWN, m.end(), OWN))
        for s in sorted(starts):
            if classes is None:
                classes = char_classes(text)
            row = np.zeros(WINDOW, np.int64)
            part = classes[s:s + WINDOW]
            row[:len(part)] = part
            rows.append(row)
            where.append((k, s, 0 if s == 0 else s + edge, len(text) if s + WINDOW >= len(text) else s + edge + OWN))
    out: list[dict[int, int]] = [{} for _ in texts]
    for i in range(0, len(rows), _BATCH):
        tags = tagger.decode(np.stack(rows[i:i + _BATCH]))
        for (k, s, a, b), row in zip(where[i:i + _BATCH], tags):
            for j in np.flatnonzero(row).tolist():
                if a <= s + j < b:
                    out[k][s + j] = int(row[j])
    return out


def added_spans(text: str, tags: dict[int, int], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of one kind in the tag sequence, cut where base spans are, trimmed, that are plausible."""
    out, start, kind, last = [], None, None, None
    runs = []
    for at in sorted(tags):
        k = (tags[at] - 1) // 2
        if start is None or at != last + 1 or k != kind or tags[at] % 2:
            if start is not None:
                runs.append((start, kind, last + 1))
            start, kind = at, k
        last = at
    if start is not None:
        runs.append((start, kind, last + 1))
    parts = []
    for a, k, b in runs:
        for x, _, y in base:            # by start; what a base span covers is told already
            if a < y and x < b:
                if a < x:
                    parts.append((a, k, x))
                a = y
        if a < b:
            parts.append((a, k, b))
    for a, k, b in parts:
        # A run that begins or ends within a word leaves that word out.
        if a > 0 and text[a - 1].isalnum() and text[a].isalnum():
            a += re.match(r"\w*", text[a:b]).end()
        if b < len(text) and text[b].isalnum() and text[b - 1].isalnum():
            b -= re.match(r"\w*", text[a:b][::-1]).end()
        piece = text[a:b]
        a, b = a + len(piece) - len(piece.lstrip(" \t\r\n,;:")), b - (len(piece) - len(piece.rstrip(" \t\r\n,;:.")))
        if a < b and plausible(k, text[a:b]):
            out.append((a, k, b))
    return out


def find_all(tagger: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    tags = network_tags(tagger, texts)
    out = []
    for text, t in zip(texts, tags):
        base = base_spans(text) if _TRIGGER.search(text) else []
        out.append((base, sorted(base + added_spans(text, t, base))))
    return out


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def mask(text: str, spans) -> str:
    """The text with every span, or run of overlapping ones, replaced by the mark of its first kind."""
    out, end = [], 0
    for a, k, b in spans:
        if a >= end:
            out += [text[end:a], MASKS[KINDS[k]]]
        end = max(end, b)
    return "".join(out) + text[end:]


def _over(docs: DataFrame, id_col: str, text_col: str, shared, columns, schema: str, keep=()):
    base = docs.select(F.col(text_col).cast("string").alias("__text"), F.col(id_col).cast("long").alias("__id"), *keep)
    extra = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        tagger = Tagger()
        tagger.p = {k: v.astype(np.float32) for k, v in pickle.loads(shared.value).items()}
        for batch in batches:
            _, offsets = utf8(batch.column(0))
            for i, j in row_pieces(np.diff(offsets), _TEXT):
                texts = [t or "" for t in batch.column(0).slice(i, j - i).to_pylist()]
                made = columns(texts, find_all(tagger, texts))
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in batch.columns[1:]] + list(made.values()),
                                                 [*batch.schema.names[1:], *made])

    out = base.mapInArrow(run, "__id long, " + (extra + ", " if extra else "") + schema)
    return out


def find(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row.

    The counts and the digest are those of the patterns' spans; ``spans`` lists all,
    with those that the network adds.  Spans are ``kind:start:end`` in code points
    by start, then kind.  A null text is empty.  Repeated rows each give a row; an
    empty table none; other columns are ignored.  The network (fixed size) is
    trained on a bounded sample of the table unless one is given.
    """
    shared = spark.sparkContext.broadcast(pickle.dumps((tagger or train(spark, docs, id_col, text_col)).p))

    def columns(texts, found):
        out = {f"n_{kind}": pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k, kind in enumerate(KINDS)}
        out["base_sha256"] = pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string())
        out["spans"] = pa.array([listed(spans) for _, spans in found], pa.string())
        return out

    schema = ", ".join(f"n_{kind} long" for kind in KINDS) + ", base_sha256 string, spans string"
    return _over(docs, id_col, text_col, shared, columns, schema).withColumnRenamed("__id", id_col)


def masked(spark: SparkSession, docs: DataFrame, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text",
           tagger: Tagger | None = None) -> DataFrame:
    """``id_col, *keep, text_col``: the texts with every span replaced by the mark of its kind; a null text stays null."""
    shared = spark.sparkContext.broadcast(pickle.dumps((tagger or train(spark, docs, id_col, text_col)).p))

    def columns(texts, found):
        return {"__masked": pa.array([mask(t, spans) for t, (_, spans) in zip(texts, found)], pa.string())}

    out = _over(docs.withColumn("__null", F.isnull(text_col)), id_col, text_col, shared, columns, "__masked string", (*keep, "__null"))
    return out.select(F.col("__id").alias(id_col), *keep, F.when(~F.col("__null"), F.col("__masked")).alias(text_col))
