"""Operator 9: secrets by a linear-chain conditional random field beside fixed patterns.

Texts are cut into words at white space. A word is tagged as the begin (B) or inside (I) of a
secret or as outside (O). The score of a tag adds weights of hashed features: the word's shape
and characters, the two words before and the one after (identity and shape), and two features of
the file (its length and its share of words with digits); tag pairs have weights too. The patterns'
matches label the training words, so the field learns what stands around secrets and how they look,
and finds those that no pattern matches. No pattern's value holds white space, so secrets of several
words are labelled by patterns of their own (quoted after a key, wrapped over lines, key blocks) and
written into passages of the training texts; from them the field learns what continues a secret.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import (
    WORD, documents, kept, materialize, numbers, prepare, split_words, strings, texts_of)

# Fixed values of the task: the patterns, the least lengths of their matches and their order.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: What a text must hold for a pattern to be tried on it (a superset of its matches).
HINTS = {"assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""", "access": "AKIA[A-Z0-9]{12}",
         "hex": "[0-9a-f]{32}"}
#: Documents with and without matches that the field is trained on, at most so many each.
TRAIN_DOCS = 150
#: Bytes of a text that the field may be trained on.
TRAIN_BYTES = 1 << 16
#: What a span must lead by (log odds), taken once where it begins and not again at its further
#: words: the field adds to patterns that stay, so it should speak only when it is sure.
MARGIN = 3.0
#: Secrets of several words: labels for training alone, never reported as the patterns' matches.
_KEY = r"""(?:password|passwd|passphrase|secret|token|api_?key)["']?\x20*[:=]\x20*"""
LONG = (
    re.compile(_KEY + r"""(["'])(?P<value>[^"'\r\n]{8,200})\1""", re.IGNORECASE | re.ASCII),
    re.compile(_KEY + r"""["']?(?P<value>[A-Za-z0-9+/_=-]{16,}(?:[\x20\\]*\r?\n\x20*(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{8,}(?![^\s"']))+)""",
               re.IGNORECASE | re.ASCII),
    re.compile(r"(?P<value>-----BEGIN [A-Z ]*PRIVATE KEY-----.{1,20000}?-----END [A-Z ]*PRIVATE KEY-----)", re.DOTALL),
)
#: Words beside a written secret, and the seed of what is written.
BESIDE, SEED = 25, 9
#: Hashed features of each family: the word, one before, two before, one after.
D = 4096
FILE = 4 * D
N_FEATURES = FILE + 64
TAGS = 3  # O, B, I
_WORD = re.compile(WORD)
_VALUE = re.compile(r"""(?s)^(?:[A-Za-z_.-]{0,40}["']?[=:])?["'(\[<{]*(.*?)["')\]>},;.!?]*$""")


def base_spans(text: str, kinds=KINDS) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the patterns' matches, in order."""
    out = []
    for k in kinds:
        for m in PATTERNS[k].finditer(text):
            value = m.group(2) if k == "assign" else m.group()
            if len(value) >= LEAST[k]:
                out.append((m.start(), KINDS.index(k), m.end()))
    return sorted(out)


def _h(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}|{value}".encode("utf-8", "surrogatepass")) % D


def _shape(w: str) -> str:
    out = []
    for c in w[:64]:
        k = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c if c < "\x7f" else "?"
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:12])


#: Features of a word as itself, at most (unused places hold N_FEATURES, whose weight is zero).
OWN = 8
MARKS = ".,;:!?\"'()|"
QUOTED = r"^[A-Za-z_.-]{0,40}[=:]?[\"']"
_LOW = zlib.crc32(b"w|")
_PLAIN: dict[int, tuple[int, int]] = {}


def odd_features(w: str) -> list[int]:
    """Feature numbers of a word that is not letters alone; the first is its shape."""
    runs = max((len(r) for r in re.findall(r"[0-9a-f]+", w)), default=0)
    own = [_h("shape", _shape(w)), _h("len", str(len(w).bit_length())), _h("digits", str(sum(c.isdigit() for c in w).bit_length())),
           _h("hex", str(runs.bit_length())), _h("upper", str(sum(c.isupper() for c in w).bit_length())),
           _h("varied", str(len(set(w)) * 4 // max(len(w), 4)))]
    m = re.match(r"([A-Za-z_.-]{1,40})[\"']?[=:]", w)
    if m:
        own.append(_h("key", m.group(1).lower()))
    return own


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features as itself [n, OWN], features as a neighbour [n, 3], whether it is odd and holds a digit)."""
    core = pc.utf8_trim(words, characters=MARKS)
    flag = lambda a, r: pc.match_substring_regex(a, r).to_numpy(zero_copy_only=False)
    low = core if not len(core) else pc.utf8_lower(core)
    near = np.empty((len(words), 3), np.int64)
    near[:, 0] = [zlib.crc32(x, _LOW) % D for x in low.cast(pa.binary()).to_numpy(zero_copy_only=False)]
    plain = flag(core, r"^\p{L}*$")
    size = np.frexp(pc.utf8_length(core).to_numpy(zero_copy_only=False).astype(float))[1]
    marks = pc.binary_length(words).to_numpy(zero_copy_only=False) > pc.binary_length(core).to_numpy(zero_copy_only=False)
    key = size * 8 + flag(core, r"^\p{Lu}") * 4 + flag(core, r"^\p{Lu}+$") * 2 + marks
    own = np.full((len(words), OWN), N_FEATURES, np.int64)
    for k in np.unique(key[plain]).tolist():
        if k not in _PLAIN:
            _PLAIN[k] = (_h("plain", str(k)), _h("plain", "any"))
        own[plain & (key == k), :2] = _PLAIN[k]
    odd = np.flatnonzero(~plain)
    for i, w in zip(odd.tolist(), strings(words.take(pa.array(odd)))):
        f = odd_features(w)
        own[i, :len(f)] = f
    near[:, 1] = own[:, 0]
    quote = flag(words, QUOTED) * 2 + flag(words, r"[\"'][.,;:)\]}]*$")
    near[:, 2] = own[:, OWN - 1] = np.array([_h("quote", str(k)) for k in range(4)])[quote]
    return own, near, ~plain & flag(words, r"[0-9]")


def file_features(n_words: np.ndarray, n_digit: np.ndarray) -> np.ndarray:
    """Two feature numbers per document."""
    size = np.minimum(np.frexp(n_words.astype(float))[1], 31)
    share = np.minimum((16 * n_digit / np.maximum(n_words, 1)).astype(int), 31)
    return np.stack([FILE + size, FILE + 32 + share], axis=1)


class Words:
    """Numbers of distinct words (0 is a text's edge) and, given weights, their scores in each position."""

    def __init__(self, weights: np.ndarray | None, limit: int = 200_000):
        self.weights, self.limit = weights, limit
        if weights is not None:
            self.padded = np.concatenate([weights, np.zeros((1, TAGS), weights.dtype)])
        self.clear()

    def clear(self):
        self.slots: dict[str, int] = {}
        self.own, self.near = np.full((1, OWN), N_FEATURES), np.array([[_h("edge", "w"), _h("edge", "s"), _h("edge", "q")]])
        self.digit = np.zeros(1, bool)
        self.scores = np.zeros((0, 4, TAGS), np.float32)

    def numbers(self, words: pa.Array) -> np.ndarray:
        d = words.dictionary_encode()
        names = strings(d.dictionary)
        if len(self.slots) > self.limit:
            self.clear()
        table = numbers(self.slots, names)
        new = np.flatnonzero(table < 0)
        if len(new):
            own, near, digit = word_features(d.dictionary.take(pa.array(new)))
            table[new] = len(self.own) + np.arange(len(new))
            self.slots.update(zip((names[i] for i in new.tolist()), table[new].tolist()))
            self.own, self.near = np.concatenate([self.own, own]), np.concatenate([self.near, near])
            self.digit = np.concatenate([self.digit, digit])
        if self.weights is not None and len(self.scores) < len(self.own):
            own, near = self.own[len(self.scores):], self.near[len(self.scores):]
            fresh = np.stack([self.padded[own].sum(axis=1), *[self.padded[k * D + near].sum(axis=1) for k in (1, 2, 3)]], axis=1)
            self.scores = np.concatenate([self.scores, fresh])
        return table[d.indices.to_numpy()] if len(names) else table


def neighbours(t: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its document, and the numbers (0 at an edge) one before, two before, one after."""
    n = np.diff(off)
    doc = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(t)) - off[:-1][doc]
    at = lambda k, ok: np.where(ok, t[np.clip(np.arange(len(t)) + k, 0, max(len(t) - 1, 0))], 0)
    return doc, at(-1, pos >= 1), at(-2, pos >= 2), at(1, pos < n[doc] - 1)


def secret_values(text: str) -> list[tuple[int, int]]:
    """Parts of the text that training takes for secrets, without keys and separators, in order:
    the values of the patterns' matches and of ``LONG``, overlapping ones as one."""
    found = []
    for s, k, e in base_spans(text):
        value = PATTERNS["assign"].match(text, s) if k == 0 else None
        found.append((value.start(2) if value else s, e))
    found += [m.span("value") for p in LONG for m in p.finditer(text)]
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def word_tags(text: str) -> tuple[list[str], list[int]]:
    """A text's words and their tags: B at the first word of a secret, I at its further words."""
    found, words, tags, last, i = secret_values(text), [], [], None, 0
    for m in _WORD.finditer(text):
        while i < len(found) and found[i][1] <= m.start():
            i += 1
        hit = i if i < len(found) and found[i][0] < m.end() else None
        words.append(m.group())
        tags.append(0 if hit is None else 1 if hit != last else 2)
        last = hit
    return words, tags


def long_examples(texts: list[str]) -> list[str]:
    """Passages of the texts that hold a secret, with one of several words written in: a quoted
    phrase after a key, a value wrapped over lines and a key block; and quoted words that are none."""
    rng = np.random.default_rng(SEED)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    code = lambda n: "".join(rng.choice(letters, n))
    pick = lambda *x: x[int(rng.integers(len(x)))]
    out = []
    for text in texts:
        values = secret_values(text)
        if not values:
            continue
        words = text.split()
        plain = [w for w in (w.strip(MARKS) for w in words[:400]) if w.isalpha()] or ["key", "word"]
        at = len(text[:values[0][0]].split())
        free = [w for w in words[max(at - 3 * BESIDE, 0):at + 3 * BESIDE] if word_tags(w)[1] == [0] and not re.search(_KEY, w, re.I)]
        key = lambda: pick("password", "passwd", "passphrase", "secret", "token", "api_key", "PASSWORD", "Token") + pick("=", ":", " = ", ": ")
        phrase = lambda: " ".join(str(w) for w in rng.choice(plain, int(rng.integers(2, 12))))
        q, head = pick('"', '"', "'"), pick("RSA ", "EC ", "", "OPENSSH ")
        size = int(rng.integers(20, 65))
        lines = lambda n: pick("\n", "\n", "\n  ").join([*(code(size) for _ in range(n)), code(int(rng.integers(8, size))) + "1="])
        none = lambda: f"{q}{phrase()}{q}"
        for x in (f"{key()}{q}{phrase()}{q}", f"{key()}{lines(int(rng.integers(1, 6)))}",
                  f"-----BEGIN {head}PRIVATE KEY-----\n{lines(int(rng.integers(2, 12)))}\n-----END {head}PRIVATE KEY-----", none()):
            k, n = int(rng.integers(0, len(free) + 1)), int(rng.integers(3, BESIDE))
            # the quoted words that are none stand in the same passage, before or after
            cut = int(rng.integers(0, n))
            before, after = free[max(k - n, 0):k], free[k:k + n]
            out.append(" ".join([*before[:cut], none(), *before[cut:], x, *after[:cut], none(), *after[cut:]]))
    return out


def train(texts: list[str], steps: int = 40, window: int = 64, l2: float = 1e-4, rate: float = 0.15):
    """(weights [features, tags], pair weights [tags, tags]) by gradient ascent (Adam) on the
    conditional likelihood of the tags of :func:`word_tags`, over all ``window``-word pieces of the
    texts and of :func:`long_examples`."""
    words = Words(None)
    tagged = [word_tags(t) for t in [*texts, *long_examples(texts)]]
    tagged = [x for x in tagged if x[0]]
    w, pair = np.zeros((N_FEATURES, TAGS)), np.zeros((TAGS, TAGS))
    if not any(any(t) for _, t in tagged):
        w[:, 0] = 1.0  # nothing to learn from: all outside
        return w.astype(np.float32), pair
    off = np.concatenate([[0], np.cumsum([len(x) for x, _ in tagged])])
    t = words.numbers(pa.array([x for ws, _ in tagged for x in ws]))
    y = np.array([k for _, ks in tagged for k in ks])
    doc, p1, p2, n1 = neighbours(t, off)
    digit = words.digit[t]
    files = file_features(np.diff(off), np.add.reduceat(digit.astype(int), off[:-1]))
    near, own = words.near, words.own
    cols = [D + near[p1], 2 * D + near[p2], 3 * D + near[n1], files[doc]]
    feats = np.concatenate([own[t], *cols], axis=1).T.astype(np.int32)  # one row per place
    pos = np.arange(len(t)) - off[:-1][doc]
    piece = np.cumsum((pos % window == 0)) - 1
    col, n = pos % window, piece[-1] + 1
    gold, mask = np.zeros((n, window), int), np.zeros((n, window), bool)
    gold[piece, col], mask[piece, col] = y, True
    both = mask[:, 1:] & mask[:, :-1]
    seen = np.zeros((TAGS, TAGS))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    wide = np.zeros((N_FEATURES + 1, TAGS))
    moments = [np.zeros_like(wide), np.zeros_like(wide), np.zeros_like(pair), np.zeros_like(pair)]
    # pieces with a secret count more, else the few are drowned
    weight = np.where((gold > 0).any(axis=1), 3.0, 1.0)
    seen = np.zeros((TAGS, TAGS))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), np.broadcast_to(weight[:, None], both.shape)[both])
    for step in range(1, steps + 1):
        e = np.zeros((n, window, TAGS))
        e[piece, col] = sum(wide[f] for f in feats)
        a = np.zeros((n, window, TAGS))
        b = np.zeros((n, window, TAGS))
        a[:, 0] = e[:, 0]
        for i in range(1, window):
            x = a[:, i - 1, :, None] + pair[None]
            top = x.max(axis=1)
            new = top + np.log(np.exp(x - top[:, None]).sum(axis=1)) + e[:, i]
            a[:, i] = np.where(mask[:, i, None], new, a[:, i - 1])
        for i in range(window - 2, -1, -1):
            x = pair[None] + (e[:, i + 1] + b[:, i + 1])[:, None, :]
            top = x.max(axis=2)
            new = top + np.log(np.exp(x - top[:, :, None]).sum(axis=2))
            b[:, i] = np.where(mask[:, i + 1, None], new, 0)
        top = a[:, -1].max(axis=1)
        z = top + np.log(np.exp(a[:, -1] - top[:, None]).sum(axis=1))
        prob = np.exp(a + b - z[:, None, None])
        pp = np.exp(a[:, :-1, :, None] + pair[None, None] + (e + b)[:, 1:, None, :] - z[:, None, None, None])
        diff = -prob[piece, col]
        diff[np.arange(len(y)), y] += 1
        diff *= weight[piece][:, None]
        g = np.zeros_like(wide)
        for f in feats:
            for k in range(TAGS):
                g[:, k] += np.bincount(f, diff[:, k], N_FEATURES + 1)
        gp = seen - (pp * (both * weight[:, None])[..., None, None]).sum(axis=(0, 1))
        scale = 1 / len(y)
        for theta, grad, m, v in ((wide, g * scale - l2 * wide, *moments[:2]), (pair, gp * scale - l2 * pair, *moments[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        wide[N_FEATURES] = 0
    return wide[:N_FEATURES].astype(np.float32), pair


def viterbi(e: np.ndarray, pair: np.ndarray, before: bool, after: bool) -> np.ndarray:
    """Best tags of a run of words; ``before``/``after``: the words beside it are surely O."""
    n = len(e)
    best, back = e[0] + (pair[0] if before else 0), np.zeros((n, TAGS), int)
    for i in range(1, n):
        x = best[:, None] + pair
        back[i] = x.argmax(axis=0)
        best = x.max(axis=0) + e[i]
    tag = int((best + (pair[:, 0] if after else 0)).argmax())
    out = np.zeros(n, int)
    for i in range(n - 1, -1, -1):
        out[i] = tag
        tag = int(back[i, tag])
    return out


def decode(e: np.ndarray, doc: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Best tags of all documents' words, as Viterbi over each whole document gives them.

    Were a run of other tags replaced by O, the path would lose at most the sum of ``gain`` over
    the run plus ``edge`` (what the pairs at its ends give); so a word in no stretch whose sum
    reaches -``edge`` is O in every best path. The rest is decoded run by run between such words,
    with O fixed on both sides, which is the same path.
    """
    step = pair[1:, 1:].max(axis=0) - pair[0, 0]
    edge = (np.maximum(pair[0, 1:] - pair[0, 0], 0) - step).max() + max(pair[1:, 0].max() - pair[0, 0], 0)
    # e's rows are summed as doubles; texts are not parted, which only keeps more words
    gain = (e[:, 1:].astype(float) - e[:, :1] + step).max(axis=1)
    run = np.concatenate([[0], np.cumsum(gain)])
    through = np.maximum.accumulate(run[:0:-1])[::-1] - np.minimum.accumulate(run[:-1])
    tags = np.zeros(len(e), np.int8)
    open_ = np.flatnonzero(through >= -edge - 1e-3)
    if not len(open_):
        return tags
    cut = np.flatnonzero((np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])) + 1
    for run in np.split(open_, cut):
        s, t = run[0], run[-1]
        tags[s:t + 1] = viterbi(e[s:t + 1].astype(float), pair, s > 0 and doc[s - 1] == doc[s],
                                t + 1 < len(doc) and doc[t + 1] == doc[t])
    return tags


def crf_spans(text: str, tags: np.ndarray) -> list[tuple[int, int]]:
    """Code-point spans of the tagged words, without a key before them and marks around them."""
    out, open_ = [], False
    for m, k in zip(_WORD.finditer(text), tags):
        if not k:
            open_ = False
            continue
        v = _VALUE.match(m.group())
        s, e = (m.start() + v.start(1), m.start() + v.end(1)) if v and v.group(1) else (m.start(), m.end())
        if k == 2 and open_:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
        open_ = True
    return out


def covered(a: int, b: int, base: list[tuple[int, int, int]]) -> bool:
    """Whether the sorted patterns' matches leave nothing of [a, b) uncovered."""
    for x, _, y in base:
        if x > a:
            break
        a = max(a, y)
    return a >= b


def scan_texts(texts: pa.Array, words: Words, pair: np.ndarray) -> list[list[tuple[int, str, int]]]:
    """Per text the spans (start, kind, end): the patterns', and the field's that reach beyond them."""
    found: list[list] = [[] for _ in range(len(texts))]
    for k in KINDS:
        for i in np.flatnonzero(pc.match_substring_regex(texts, HINTS[k]).to_numpy(zero_copy_only=False)):
            found[i] += base_spans(texts[int(i)].as_py(), (k,))
    flat, off = split_words(texts)
    t = words.numbers(flat)
    doc, p1, p2, n1 = neighbours(t, off)
    s = words.scores
    e = s[t, 0] + s[p1, 1] + s[p2, 2] + s[n1, 3] if len(t) else np.zeros((0, TAGS), np.float32)
    run = np.concatenate([[0], np.cumsum(words.digit[t])])
    files = file_features(np.diff(off), run[off[1:]] - run[off[:-1]])
    e = e + words.weights[files].sum(axis=1)[doc]
    # a span begins with B, or with I after O or at a text's edge
    e[:, 1] -= MARGIN
    e[off[:-1][np.diff(off) > 0], 2] -= MARGIN
    begin = np.zeros((TAGS, TAGS))
    begin[0, 2] = MARGIN
    tags = decode(e, doc, pair - begin)
    out = []
    extra = set(doc[np.flatnonzero(tags)].tolist())
    for i, base in enumerate(found):
        base = sorted(base)
        spans = [(a, KINDS[k], b) for a, k, b in base]
        if i in extra:
            for a, b in crf_spans(texts[i].as_py(), tags[off[i]:off[i + 1]]):
                if not covered(a, b, base):
                    spans.append((a, "crf", b))
            order = {k: n for n, k in enumerate((*KINDS, "crf"))}
            spans.sort(key=lambda x: (x[0], order[x[1]]))
        out.append(spans)
    return out


def fit(spark: SparkSession, docs: DataFrame, n: int = TRAIN_DOCS):
    """The field's weights, trained on at most ``n`` documents that hold a match of the patterns
    and ``n`` that hold none, those with the least hashes of doc_id and text among those of at most
    ``TRAIN_BYTES`` (so that what reaches the driver is bounded)."""
    prepare(spark)
    hint = "|".join(h if h[0] != "(" else f"({h})" for h in HINTS.values())
    t = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    t = t.where(F.octet_length("text") <= TRAIN_BYTES)
    light = materialize(spark, t.select("h", F.col("text").rlike(hint).alias("hit")), "hits")
    texts = []
    for hit in (True, False):
        # hashes first: only the chosen rows' texts travel
        pick = light.where(F.col("hit") == hit).select("h").distinct().orderBy("h").limit(n)
        texts += [r["text"] for r in t.join(F.broadcast(pick), "h").dropDuplicates(["h"]).orderBy("h").collect()]
    return train(texts)


def words_of(weights: np.ndarray) -> Words:
    """One per Python worker and model, kept between tasks."""
    return kept(("secrets", zlib.crc32(weights.tobytes())), lambda: Words(weights))


def secret_spans(spark: SparkSession, docs: DataFrame, model=None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``.

    The patterns' matches always stay; the field's spans (kind ``crf``) are added, whole, where they
    reach beyond the matches. Null and empty texts have no spans; repeated rows and null ids are returned as they come;
    other columns are not looked at. Without any match in the table the field adds nothing.
    """
    prepare(spark)
    model = model or fit(spark, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = scan_texts(texts_of(b.column(1)), words_of(model[0]), model[1])
            join = lambda s: ",".join(f"{k}:{a}:{z}" for a, k, z in s)
            base = [[x for x in r if x[1] != "crf"] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([sum(x[1] == k for x in r) for r in rows], pa.int64()) for k in KINDS],
                 pa.array([hashlib.sha256(join(r).encode()).hexdigest() for r in base], pa.string()),
                 pa.array([join(r) for r in rows], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(spark: SparkSession, docs: DataFrame, mark: str = "<redacted>", model=None) -> DataFrame:
    """``docs`` with ``mark`` in place of every span found (overlapping spans as one) and n_chars,
    where there is such a column, counted anew for the texts that changed."""
    prepare(spark)
    model = model or fit(spark, docs)
    cols = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(b.schema.get_field_index("text"))
            out = column.to_pylist()
            changed = {}
            for i, spans in enumerate(scan_texts(texts_of(column), words_of(model[0]), model[1])):
                if spans:
                    merged: list[list[int]] = []
                    for s, _, e in spans:
                        if merged and s < merged[-1][1]:
                            merged[-1][1] = max(e, merged[-1][1])
                        else:
                            merged.append([s, e])
                    text = out[i]
                    for s, e in reversed(merged):
                        text = text[:s] + mark + text[e:]
                    out[i] = changed[i] = text
            new = {"text": pa.array(out, pa.string())}
            if "n_chars" in cols:
                n = b.column(b.schema.get_field_index("n_chars"))
                values = n.to_pylist()
                for i, text in changed.items():
                    values[i] = len(text)
                new["n_chars"] = pa.array(values, n.type)
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(k)) for k, c in enumerate(b.schema.names)],
                                             names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(spark, documents(spark, sf_dir))
