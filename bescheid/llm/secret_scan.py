"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens that adds spans."""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crf
from .common import chunks, mapped, ship, strings, table

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_GATES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
#: Words that announce a secret, as the end of a token's letters in lower case.
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "accesskey", "privatekey", "bearer", "authorization", "credential", "credentials", "auth")
#: First characters of issued keys.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk-", "AIza", "eyJ", "npm_", "pypi-", "SG.")
#: Characters whose tokens are looked at together: their features take about 200 bytes each.
CHUNK = 200_000
O, B, I = 0, 1, 2  # noqa: E741
_SPACE = np.array([chr(i).isspace() or not i for i in range(0x3001)])  # NUL parts the texts of a chunk
_TRIM = "\"'`,;()[]{}<>"
#: The announcing words in lower case, with other marks between their letters; `_announces` decides.
_ANNOUNCE = re.compile("|".join(r"[^a-z\s=\x00]*".join(k) for k in KEYWORDS))
#: What the field reads of a token: its shape, then its neighbourhood.
FEATURES = (
    "bias", "long12", "long16", "long24", "long36", "letters_and_digits", "three_kinds", "digits", "changes", "symbols", "number", "mail", "address", "known_prefix", "hex16", "loose", "loose_three_kinds",
    "few_vowels", "capitals_side_by_side", "file_name", "hyphens", "told_usable", "after_sign", "named_random", "told_random", "usable_before_candidate",
    "told_two_kinds", "told_three_kinds", "lone_after_sign", "lone_long", "lone_bearer", "told_sign_two_kinds",
)


def _letters(tok: str) -> str:
    return "".join(c for c in tok.partition("=")[0].lower() if "a" <= c <= "z")


def _announces(tok: str) -> bool:
    return _letters(tok).endswith(KEYWORDS)


def _tokens_at(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of all tokens of the joined texts."""
    white = np.where(cp <= 0x3000, _SPACE[np.minimum(cp, 0x3000)], False)
    edge = np.diff(white.astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _member(chars: str) -> np.ndarray:
    return np.isin(np.arange(129), [ord(c) for c in chars])


_LOWER, _UPPER, _DIGIT = (_member(x) for x in (string.ascii_lowercase, string.ascii_uppercase, string.digits))
_IS_TRIM, _IS_STOP, _IS_HEX, _IS_VOWEL = (_member(x) for x in (_TRIM, ".!?:", string.hexdigits, "aeiouyAEIOUY"))
_IS_SIGN = _member("".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "-"))


def token_features(joined: str, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, part: np.ndarray, named: np.ndarray) -> np.ndarray:
    """The features of every token, by whole-array steps over prefix sums. `named`: whether its text names secrets.

    A token's core is what remains without quotes and brackets and, if it holds an equals sign, after the first.
    """
    low = np.minimum(cp, 128)
    place = np.arange(len(cp), dtype=np.int64)

    def sums(flags: np.ndarray):
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))
        return lambda a, b: (total[b] - total[a]).astype(np.float32)

    def after(flags: np.ndarray) -> np.ndarray:
        """For each place the next at or after it where the flag is set."""
        return np.append(np.minimum.accumulate(np.where(flags, place, len(cp))[::-1])[::-1], len(cp))

    def before(flags: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(flags, place, -1))

    is_lower, is_upper, is_digit, trim = _LOWER[low], _UPPER[low], _DIGIT[low], _IS_TRIM[low]
    first = after(~trim)
    begin = np.minimum(first[starts], ends)
    end = np.maximum(before(~trim)[ends - 1] + 1, begin)
    sign = after(cp == ord("="))[begin]
    value = np.minimum(first[np.minimum(sign + 1, len(cp))], end)
    cut = (sign < end - 2) & (value < end)
    begin = np.where(cut, value, begin)
    size = end - begin
    n = np.maximum(size, 1).astype(np.float32)
    n_lower, n_upper, n_digit = (sums(x) for x in (is_lower, is_upper, is_digit))
    lower, upper, digit = n_lower(begin, end), n_upper(begin, end), n_digit(begin, end)
    symbol = size - lower - upper - digit
    kind = is_lower * np.int8(1) + is_upper * np.int8(2) + is_digit * np.int8(3)
    change = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 0)))
    inner = np.minimum(begin + 1, end)
    rate = sums(change)(inner, end) / np.maximum(n - 1, 1)
    colon = cp == ord(":")
    slashes = np.zeros(len(cp), bool)
    slashes[:-2] = colon[:-2] & (cp[1:-1] == ord("/")) & (cp[2:] == ord("/"))
    web = np.zeros(len(cp), bool)
    web[:-3] = (cp[:-3] == ord("w")) & (cp[1:-2] == ord("w")) & (cp[2:-1] == ord("w")) & (cp[3:] == ord("."))
    url = (sums(slashes)(begin, np.maximum(end - 2, begin)) > 0) | (web[np.minimum(begin, len(cp) - 1)] & (size >= 4))
    mail = sums(cp == ord("@"))(begin, end) > 0
    known = np.zeros(len(starts), bool)
    for k in np.flatnonzero(size >= 16).tolist():
        known[k] = joined.startswith(PREFIXES, int(begin[k]))
    letter = lower + upper
    two, three = (digit > 0) & (letter > 0), (digit > 0) & (upper > 0) & (lower > 0)
    loose = (two | ((lower > 0) & (upper > 0))) & (size >= 16) & (rate >= 0.2) & (symbol <= size // 5) & ~mail & ~url
    random_like = loose | known
    hexed = (size >= 16) & (sums(_IS_HEX[low])(begin, end) == size)
    rare = (size >= 16) & (letter == size) & (sums(_IS_VOWEL[low])(begin, end) < 0.27 * n)
    beside = np.concatenate(([False], is_upper[1:] & is_upper[:-1]))
    capitals = (sums(beside)(inner, end) >= 2) & (lower >= 2) & (size >= 16)
    dot = before(cp == ord("."))[np.maximum(end - 1, 0)]
    tail = end - dot - 1
    suffixed = (dot > begin) & (tail >= 2) & (tail <= 4) & (n_lower(np.minimum(dot + 1, end), end) == tail)
    hyphens = np.minimum(sums((cp == ord("-")) | (cp == ord("/")))(begin, end), 4) / 4

    announcing, own, bearer = (np.zeros(len(starts), bool) for _ in range(3))
    small = joined.replace("\u0130", "I").lower()  # the one letter whose small form is longer
    at = np.array([m.start() for m in _ANNOUNCE.finditer(small)], np.int64)
    for k in np.unique(np.searchsorted(starts, at, side="right") - 1).tolist():
        letters = _letters(tok := joined[starts[k] : ends[k]])
        if letters.endswith(KEYWORDS):
            announcing[k], own[k], bearer[k] = True, "=" in tok, letters.endswith("bearer")
    one, two_back = (np.zeros(len(starts), bool) for _ in range(2))
    one[1:] = part[1:] == part[:-1]
    two_back[2:] = part[2:] == part[:-2]
    told = own | (one & np.roll(announcing, 1)) | (two_back & np.roll(announcing, 2))
    mid_end = np.maximum(before(~_IS_STOP[low])[np.maximum(end - 1, 0)] + 1, begin)
    mid = mid_end - begin
    kinds = (n_lower(begin, mid_end) > 0).astype(np.int8) + (n_upper(np.minimum(begin + 1, mid_end), mid_end) > 0) + (n_digit(begin, mid_end) > 0) + (sums(_IS_SIGN[low])(begin, mid_end) > 0)
    usable = (ends - starts >= 8) & (random_like | two)
    quote = (cp == ord('"')) | (cp == ord("'"))
    last = cp[np.maximum(before(~quote)[ends - 1], starts)]
    signed = one & np.roll((last == ord("=")) | (last == ord(":")), 1)
    led = one & np.roll(bearer, 1)
    candidate = (ends - starts >= 16) | ((ends - starts >= 8) & (n_digit(starts, ends) > 0))
    following = np.zeros(len(starts), bool)
    following[:-1] = candidate[1:] & one[1:]
    lone = told & ~two & ~random_like
    announced = signed | own
    return np.column_stack((
        np.ones(len(starts)), size >= 12, size >= 16, size >= 24, size >= 36, two, three, digit / n, rate, symbol / n, digit == size, mail, url, known, hexed, loose, loose & three,
        rare, capitals, suffixed, hyphens, told & usable, signed & (usable | told), named & random_like, told & random_like, usable & following,
        told & (kinds >= 2), told & (kinds >= 3), lone & announced, lone & (announced | led) & (mid >= 10), lone & led & (mid >= 16), told & announced & (kinds >= 2),
    )).astype(np.float32)


def _word(r: random.Random, letters: str = string.ascii_lowercase) -> str:
    """An invented word, every third letter or so a vowel, as in prose."""
    return "".join(r.choice("aeiou") if r.random() < 0.38 else r.choice(letters) for _ in range(r.randint(1, 14)))


def examples(count: int, seed: int) -> Iterator[list[tuple[str, int]]]:
    """Invented token lists with labels: prose with secrets of many forms and with look-alikes that are none."""
    r = random.Random(seed)
    alnum, b64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    some = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))
    for _ in range(count):
        toks: list[tuple[str, int]] = []
        letters = r.choice((string.ascii_lowercase, string.ascii_lowercase + "äöüßéèêçñáíó"))
        style = r.random()
        for _ in range(r.randint(8, 40)):
            w, p = _word(r, letters), r.random()
            if style < 0.08:
                w = w.upper() + "!!"
            elif style < 0.16:
                w += r.choice(("***", "$$$", "###", "&&&", "%%%"))
            elif style < 0.2:
                toks.append(("|", O))
            elif p < 0.15:
                w = w.capitalize()
            elif p < 0.2:
                w += r.choice(",.")
            toks.append((w, O))
            p = r.random()
            if p < 0.05:
                value = r.choice((some(alnum, 20, 40), "ghp_" + some(alnum, 36, 36), "sk_live_" + some(alnum, 24, 24), "xoxb-" + some(string.digits, 11, 11) + "-" + some(alnum, 24, 24), "AIza" + some(alnum + "_-", 35, 35), "eyJ" + some(b64, 30, 60) + "." + some(b64, 30, 60), "glpat-" + some(alnum, 20, 20), "sk_live_" + some(string.ascii_letters, 24, 24), "ghp_" + some(string.ascii_letters, 36, 36), some(string.ascii_letters, 20, 40), some(string.ascii_letters, 32, 64), r.choice(("sk_live_", "sk-", "npm_", "github_pat_", "pypi-")) + "".join(_word(r)[:8].capitalize() for _ in range(5)) + some(alnum, 6, 10)))
                lead = r.choice((["password", "="], ["token:"], ["secret", "is"], ["Bearer"], ["Authorization:", "Bearer"], ["api_key", ":"], ["credentials"], ["pwd="], [], [], []))
                toks += [(x, O) for x in lead]
                toks.append((r.choice((value, value, f'"{value}"', f"'{value}',", f"{value}.")), B))
            elif p < 0.06:
                toks += [("-----BEGIN", O), ("PRIVATE", O), ("KEY-----", O), (some(b64, 64, 64) + "7a", B), (some(b64, 64, 64) + "x4", I), (some(b64, 20, 64) + "9B=", I)]
            elif p < 0.08:
                toks += _announced(r, some)
            elif p < 0.17:
                name = _word(r)
                toks.append((r.choice((
                    f"+{some('123456789', 1, 2)}-{some(string.digits, 3, 3)}-{some(string.digits, 7, 7)}", some(string.digits, 8, 16), f"{_word(r)}.{_word(r)}{some(string.digits, 1, 3)}@example.com",
                    f"https://{_word(r)}.example.org/{_word(r)}/{some(string.digits, 1, 6)}?id={some(alnum, 1, 6)}", f"{some('12', 1, 1)}{some(string.digits, 1, 2)}.{some(string.digits, 1, 3)}.{some(string.digits, 1, 3)}.{some(string.digits, 1, 3)}", f"20{some(string.digits, 2, 2)}-0{some('123456789', 1, 1)}-1{some(string.digits, 1, 1)}",
                    f"{_word(r)}{some(string.digits, 1, 4)}", f"{some(string.digits, 3, 4)}-{some(string.digits, 4, 4)}", f"v{some(string.digits, 1, 2)}.{some(string.digits, 1, 2)}.{some(string.digits, 1, 3)}", f"{some(string.digits, 1, 3)},{some(string.digits, 3, 3)}.{some(string.digits, 2, 2)}", f"DE{some(string.digits, 20, 20)}", f"isbn{some(string.digits, 13, 13)}",
                    "".join(_word(r)[:9].capitalize() for _ in range(r.randint(2, 6))), name[:6] + "".join(_word(r)[:9].capitalize() for _ in range(r.randint(2, 5))), "-".join(_word(r) for _ in range(r.randint(2, 6))), "-".join(some("0123456789abcdef", k, k) for k in (8, 4, 4, 4, 12)), f"#{some('0123456789abcdef', 7, 12)}",
                    f"{r.choice(('IMG', 'DSC', 'Scan', name))}{r.choice(('_', '-', ''))}20{some(string.digits, 6, 6)}{r.choice(('_', '-', 'WA', ''))}{some(string.digits, 4, 6)}{r.choice(('', '', some(string.ascii_letters, 1, 4)))}.{r.choice(('jpg', 'png', 'pdf', 'xlsx', 'txt'))}",
                    f"{name}_{_word(r)}_{some(string.digits, 1, 4)}.{r.choice(('csv', 'py', 'docx', 'html'))}", f"{some(string.ascii_uppercase, 2, 4)}-20{some(string.digits, 2, 2)}-{some(string.digits, 4, 6)}", f"20{some(string.digits, 2, 2)}-01-{some('12', 1, 1)}{some(string.digits, 1, 1)}T1{some('0123', 1, 1)}:{some('012345', 1, 1)}{some(string.digits, 1, 1)}:00Z", f"{_word(r)}_{_word(r)}_{some(string.digits, 2, 4)}", "".join(_word(r, letters) for _ in range(r.randint(3, 5))),
                    f"/{_word(r)}/{_word(r)}/{_word(r)}{some(string.digits, 1, 3)}/{_word(r)}", f"{some(string.ascii_uppercase, 1, 3)}{some(string.digits, 2, 4)}-{some(string.ascii_uppercase, 1, 2)}{some(string.digits, 1, 2)}", "".join(_word(r, letters) for _ in range(r.randint(2, 4))).capitalize(),
                )), O))
            elif p < 0.19:
                toks += [(x, O) for x in r.choice((["the", "secret", "is"], ["token", "of"], ["password", "policy"]))]
            elif p < 0.23:
                toks += [(x, O) for x in (*r.choice((["the", "secret", "is"], ["token", "of"], ["Password:"], ["password"], ["secret", "of", "the"], ["bearer", "of"], ["credentials"], ["Token:"], ["auth"])), _word(r, letters)[:9] + r.choice(("", "", ",", ".")), _word(r, letters))]
        yield toks


def _announced(r: random.Random, some) -> list[tuple[str, int]]:
    """Announced secrets that are short or have no digit."""
    mixed = "".join(r.sample([r.choice(string.ascii_lowercase), r.choice(string.ascii_uppercase), r.choice(string.digits), r.choice("!#$%&*+?@^_"), *some(string.ascii_letters + string.digits, 0, 8)], 4)) + some(string.ascii_letters + string.digits + "!#$%&*", 1, 8)
    lone = r.choice((some(string.ascii_letters, 16, 40), some(string.ascii_lowercase, 10, 30)))
    lead, value = r.choice(((["Authorization:", "Bearer"], some(string.ascii_letters, 16, 40)), (["Bearer"], some(string.ascii_lowercase, 20, 40)), (["pwd:"], lone), (["password:"], lone), (["password", "="], lone), (["token", ":"], lone), (["secret="], lone), (["password", "is"], mixed), (["pwd:"], mixed), (["password", "="], mixed), (["secret", ":"], mixed), (["credentials"], mixed)))
    if r.random() < 0.15:
        return [(r.choice(("password=", "pwd=", "api_key=")) + r.choice((mixed, lone)), B)]
    return [*((x, O) for x in lead), (r.choice((value, value, f'"{value}"', f"{value},")), B)]


def _of_texts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts, and the starts, ends, text numbers and features of all tokens; last their code points."""
    joined = "\x00".join(texts) + "\x00"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    starts, ends = _tokens_at(cp)
    part = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    named = np.array([any(g in low for g in _GATES) for low in (t.encode("utf-8", "surrogatepass").lower() for t in texts)], bool)
    return joined, starts, ends, part, token_features(joined, cp, starts, ends, part, named[part] if len(starts) else np.zeros(0, bool)), cp


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, np.ndarray]:
    """The field, fitted on invented examples with a fixed seed: the same weights everywhere."""
    rows = list(examples(1500, 20240131))
    x = _of_texts([" ".join(w for w, _ in row) for row in rows])[4]
    y = np.array([label for row in rows for _, label in row])
    return crf.train(x.astype(np.float64), y, np.array([len(row) for row in rows]), 3, steps=160, rate=0.25, l2=0.3)


def _decided(unary: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Tokens that are outside on every best path, whatever stands beside them."""
    gain = [(trans[:, k] - trans[:, O]).max() + (trans[k] - trans[O]).max() for k in (B, I)]
    return (unary[:, O] - unary[:, B] > gain[0]) & (unary[:, O] - unary[:, I] > gain[1])


def _added(joined: str, starts: np.ndarray, ends: np.ndarray, part: np.ndarray, x: np.ndarray, weights: np.ndarray, trans: np.ndarray) -> list[tuple[int, int]]:
    """Spans that Viterbi tags in the joined texts.

    Every token is scored. One that prefers "outside" by more than its two transitions can make up for is outside
    on every best path (`_decided`), so decoding the stretches between such tokens is decoding the whole sequence.
    """
    unary = x @ weights
    open_ = np.flatnonzero(~_decided(unary, trans)) if len(starts) else starts
    out = []
    breaks = np.flatnonzero((np.diff(open_) > 1) | (np.diff(part[open_]) > 0)) + 1
    for stretch in np.split(open_, breaks) if len(open_) else []:
        i, j = int(stretch[0]), int(stretch[-1]) + 1
        begin = None
        for k, tag in enumerate([*crf.viterbi(unary[i:j], trans, O), O], i):
            if begin is not None and tag != I:
                out.append((int(starts[begin]), int(ends[k - 1])))
                begin = None
            if tag == B or (tag == I and begin is None):
                begin = k
    spans = []
    for s, e in out:
        while s < e and joined[s] in _TRIM:
            s += 1
        while e > s and joined[e - 1] in _TRIM:
            e -= 1
        if s < e:
            spans.append((s, e))
    return spans


Field = tuple[np.ndarray, np.ndarray]


def scan(texts: list[str], field: Field | None = None, added: bool = True) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, end, kind number), by start then kind; code points, end exclusive.

    Base spans are the fixed patterns' matches, leftmost and non-overlapping per kind. The field adds spans
    that hold a letter or digit outside all base spans; they may overlap some. Empty texts have none.
    """
    weights, trans = (field or model()) if added else (None, None)
    found: list[list[tuple[int, int, int]]] = []
    for part in chunks(texts, CHUNK):
        own = texts[part]
        # a text's own NUL only ends a hex run or a token, as any non-hex mark does
        joined, starts, ends, number, x, cp = _of_texts(own)
        offset = np.concatenate(([0], np.cumsum([len(t) + 1 for t in own])))
        rows: list[list[tuple[int, int, int]]] = [[] for _ in own]
        for i, t in enumerate(own):
            low = t.encode("utf-8", "surrogatepass").lower()
            if any(g in low for g in _GATES):
                rows[i] += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
            if b"akia" in low:
                rows[i] += [(m.start(), m.end(), 1) for m in ACCESS.finditer(t) if m.end() - m.start() >= 18]
        plain = np.flatnonzero(~(((cp >= 48) & (cp <= 57)) | ((cp >= 97) & (cp <= 102))))
        for k in np.flatnonzero(np.diff(plain, prepend=-1) > 16).tolist():
            e = int(plain[k])
            s = int(plain[k - 1]) + 1 if k else 0
            i = int(np.searchsorted(offset, s, side="right")) - 1
            rows[i].append((s - int(offset[i]), e - int(offset[i]), 2))
        if added:
            inside = np.zeros(len(cp), bool)
            for i, r in enumerate(rows):
                for s, e, _ in r:
                    inside[offset[i] + s : offset[i] + e] = True
            for s, e in _added(joined, starts, ends, number, x, weights, trans):
                if any(c.isalnum() and not held for c, held in zip(joined[s:e], inside[s:e].tolist(), strict=True)):
                    i = int(np.searchsorted(offset, s, side="right")) - 1
                    rows[i].append((s - int(offset[i]), e - int(offset[i]), 3))
        found += [sorted(r, key=lambda x: (x[0], x[2])) for r in rows]
    return found


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "<secret>") -> str:
    """`text` with each stretch of overlapping spans replaced by `mark`."""
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def _scanner(field: Field):
    def scanner(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = scan(strings(b["text"]), field)
            base = [[x for x in r if x[2] < 3] for r in found]
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64"),
                **{f"n_{KINDS[k]}": [sum(x[2] == k for x in r) for r in found] for k in range(4)},
                "base_sha256": [hashlib.sha256(as_text(r).encode()).hexdigest() for r in base],
                "spans": [as_text(r) for r in found],
            })

    return scanner


def find(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): counts by kind, digest of the base spans, all spans.

    A narrow stage over whole texts, with one field, fitted on the driver, for all tasks. Null texts are empty: no
    spans, the digest of the empty string. A very long text is scanned whole, alone; time and memory grow with its
    length. A null doc_id stays null. Repeated rows each have their row. Empty table: no rows. Other columns are
    not read.
    """
    ship(docs.sparkSession)
    return mapped(docs.select("doc_id", "text"), _scanner(model()), "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span of its column text replaced by a mark; nulls and all other columns stay.

    Empty texts stay empty, very long ones are scanned whole, repeated rows stay. Empty table: no rows.
    """
    ship(docs.sparkSession)
    field = model()

    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        texts = strings(text)
        return pd.Series([redacted(t, s) if isinstance(x, str) else None for x, t, s in zip(text.tolist(), texts, scan(texts, field), strict=True)], dtype=object)

    return docs.withColumn("text", clean("text"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; see `find`."""
    return find(table(spark, sf_dir, "documents", "doc_id", "text", deal=True))
