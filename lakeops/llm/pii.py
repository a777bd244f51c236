"""Personal data by candidates, boosted trees and calibrated thresholds.

Base rules find emails, IP addresses, card and phone numbers by their form alone; what they
find always stays. High-recall generators then propose further, overlapping spans: values
assigned to a secret's name, long mixed tokens, digit groups, spelled-out emails, account
numbers by form and by the name before them. Gradient-boosted trees judge each candidate by
format (lengths, digits, entropy, check digits) and context (words and signs before it). A
threshold for each generator, calibrated on held-out candidates, selects; of overlapping
selections the likelier stays, and nothing that overlaps a base span is added.

The trees are trained here, on ``TRAIN_ROWS`` labelled candidates: sentences written by a
seeded generator around true and false personal data. Thresholds are set on sentences of
other patterns than the trees have seen. No document is needed for either.

All scanning is linear in the length of a text, and a secret of any length under a name of any
length is one span. A digit group is a candidate from ``LEAST_DIGITS`` digits on, the value
behind an account's name from so many signs on. Offsets are code points, ends exclusive.

Defined cases: a null or empty text has no spans; repeated rows are answered each; an empty
table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.words import hidden, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
#: In the order of spans that start together: base kinds first.
KINDS = (*BASE_KINDS, "secret", "account", "number")
TRAIN_ROWS = 6000
PRECISION = 0.99
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    last = 0
    at = text.find("@")
    while at >= 0:
        before = text[last:at]
        start = last + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end(), "email"
        last = found.end() if found else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[Span]:
    out = list(_emails(text)) if "@" in text else []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in four)):
                out.append((at, end, "ip"))
            at = end + 1
    for m in _DIGITS.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


LEAST_DIGITS = 6
# Words that name what follows.
SECRET_WORDS = ("password", "passwd", "pwd", "passphrase", "passcode", "token", "secret", "apikey", "api_key", "api-key", "access_key", "private_key", "auth", "bearer", "credential", "passwort", "kennwort", "contraseña")
PHONE_WORDS = ("phone", "telephone", "tel", "call", "mobile", "cell", "fax", "ring", "text", "whatsapp", "telefon", "handy", "téléphone", "portable", "teléfono", "móvil", "ruf")
ACCOUNT_WORDS = ("iban", "account", "acct", "konto", "compte", "cuenta", "ssn", "social security", "passport", "passeport", "reisepass", "pasaporte", "card", "carte", "tarjeta", "karte", "driver's license", "driving licence", "tax id", "taxpayer", "national insurance", "dni", "nif")
PLAIN_WORDS = ("order", "version", "page", "year", "isbn", "issue", "chapter", "commit", "sha", "ref", "model", "price", "invoice", "population", "build", "serial", "sku", "revision", "checksum")
# Last labels of common addresses.
TOP_DOMAINS = frozenset("com org net edu gov info biz io co me de fr es it nl uk us ca ch at be pl se eu".split())

# a name of any length that holds one of the words, and what leads to its value
_SECRET = re.compile(r"(?i:pass(?:word|wd|phrase|code|wort)|pwd|token|secret|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential|kennwort|contraseña)")
_NAME = re.compile(r"(?<![\w-])([\w-]++)[\"']?\s*+(?:=>?|:=?|is\b)\s*+[\"']?")
_VALUE = re.compile(r"[^\s\"',;<>]{4,}+")
_DOT = r"(?:\s?[(\[{<]\s?(?i:dot)\s?[)\]}>]\s?|\s(?i:dot)\s)"
#: Kind of what each generator proposes; the first reads ``_NAME`` and ``_VALUE``.
GENERATORS: list[tuple[str, re.Pattern]] = [
    ("secret", _NAME),
    ("secret", re.compile(r"(?<![A-Za-z0-9_+/-])([A-Za-z0-9_+/-]{16,}+={0,2})(?![A-Za-z0-9_+/-])")),
    ("email", re.compile(rf"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++(?:\s?[(\[{{<]\s?(?i:at)\s?[)\]}}>]\s?[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)+|\s(?i:at)\s[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+))")),
    ("account", re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?:\s?[A-Z0-9]{4}){2,7}(?:\s?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")),
    ("number", re.compile(r"(?<![0-9A-Za-z.+])(\(?[0-9]++\)?(?:[\x20./-]{1,2}\(?[0-9]++\)?)*)(?![0-9A-Za-z])")),
    ("account", re.compile(rf"(?<![^\W_])(?i:{'|'.join(ACCOUNT_WORDS)})(?![^\W_])(?:[\s#:=.,(-]|(?i:no|nr|num|number|id|is|was|of|the|holder|numéro|numero|número|nummer|n°)(?![^\W_]))*+([A-Z0-9]++(?:[\x20-][A-Z0-9]++)*+)(?![^\W_])")),
]
# How keys of well-known services begin.
_KEY_START = re.compile(r"(?:sk_|pk_|AKIA|ASIA|ghp_|gho_|xox[abp]-|AIza)")
# whole words only, as short ones turn up inside others in any language; a border is also where
# the case changes, and a plural counts
_NAMED = [
    re.compile(rf"(?:(?<![^\W\d_])|(?<=[a-z])(?=[A-Z]))(?i:{'|'.join(map(re.escape, words))})(?:(?i:e?s))?(?:(?![^\W\d_])|(?<=[a-z])(?=[A-Z]))")
    for words in (SECRET_WORDS, PHONE_WORDS, ACCOUNT_WORDS, PLAIN_WORDS)
]
_CONTEXT = 40
_DATE = re.compile(r"(?:1[5-9]|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:(?:1[5-9]|20)[0-9]{2}|[0-9]{2})")
_RUN = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"[0-9]")
# every generator needs one of these; a text without them has no candidate
_HINT = re.compile(r"[@(\[{=:<]|[0-9]|\bis\b|\s[aA][tT]\s")


@dataclass
class Candidate:
    start: int
    end: int
    generator: int
    features: list[float] = field(default_factory=list)


def features_of(text: str, start: int, end: int, generator: int, name: str = "") -> list[float]:
    """Format of the value and what stands before it; ``name`` is the name it is assigned to."""
    value = text[start:end]
    n = len(value)
    digits = "".join(c for c in value if c.isdigit() and c.isascii())
    counts = Counter(value)
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    before = text[max(0, start - _CONTEXT) : start]
    # how far back the last word of each sort ends
    away = [min((len(before) - m.end() for m in words.finditer(before)), default=_CONTEXT + 1) for words in _NAMED]
    # letters of the name behind its word: none in dbpassword, four in tokenizer
    tail = min((len(name) - m.end() for m in _SECRET.finditer(name)), default=-1)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    groups = [len(g) for g in _RUN.findall(value)] or [0]
    words = [len(w) for w in _LETTERS.findall(value)] or [0]
    letters = value.split()[-1].rstrip(".").rsplit(".", 1)[-1].strip(")]}>").lower() if value.strip() else ""
    return [
        float(generator), n, len(digits), len(digits) / n, sum(c.isupper() for c in value), sum(c.islower() for c in value),
        sum(not c.isalnum() for c in value), entropy, float(all(c in string.hexdigits for c in value)), changes,
        float(len(digits) > 1 and luhn(digits)), *away, tail, float(before.rstrip(" \"'")[-1:] in ("=", ":")),
        float(text[end : end + 1] in ('"', "'")), float(_check_account(value)), float(bool(_KEY_START.match(value))),
        len(groups), groups[0], groups[-1], max(groups), max(words), float(bool(_DATE.fullmatch(value))),
        float(letters in TOP_DOMAINS), float(any(c in "([{<" for c in value)), value.count("."), float(text[start - 1 : start] in ("$", "€", "£")),
    ]


def _check_account(value: str) -> bool:
    """The check digits of an international account number."""
    v = value.replace(" ", "")
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", v):
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _assigned(text: str) -> Iterator[tuple[int, int, str]]:
    """Values that are assigned to a name with a secret's word in it, and that name."""
    at = 0
    while lead := _NAME.search(text, at):
        at = lead.end()
        if _SECRET.search(lead[1]) and (value := _VALUE.match(text, at)):
            at = value.end()
            yield value.start(), at, lead[1]


def candidates_of(text: str) -> list[Candidate]:
    out = []
    if not _HINT.search(text):
        return out
    lower = text.lower()
    if any(w in lower for w in ("pass", "pwd", "token", "secret", "key", "auth", "bearer", "credential", "kennwort", "contrase")):
        out += [Candidate(start, end, 0, features_of(text, start, end, 0, name)) for start, end, name in _assigned(text)]
    for g, (_, pattern) in enumerate(GENERATORS):
        if g == 0 or g == 2 and not re.search(r"\bat\b", lower):
            continue
        if g == 5 and not any(w in lower for w in ACCOUNT_WORDS):
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1)
            if g in (1, 5) and not _DIGIT.search(text, start, end):
                continue
            if g >= 4 and (end - start < LEAST_DIGITS or g == 4 and len(m[1]) - sum(map(m[1].count, " ./-()")) < LEAST_DIGITS):
                continue
            out.append(Candidate(start, end, g, features_of(text, start, end, g)))
    return out


class Boosted:
    """Gradient-boosted trees of depth three for a yes-or-no label, with histogram splits."""

    def __init__(self, rounds: int = 40, rate: float = 0.3, depth: int = 3, bins: int = 32):
        self.rounds, self.rate, self.depth, self.bins = rounds, rate, depth, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], 1)
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base, self.trees = math.log(p / (1 - p)), []
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            tree: dict[int, tuple] = {}
            self._grow(tree, 1, np.arange(len(y)), binned, y - q, q * (1 - q), self.depth)
            self.trees.append(tree)
            score += self._tree(tree, binned)
        return self

    def _grow(self, tree: dict, node: int, rows: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum() + 1.0
        best = (1e-6, -1, 0)
        if depth:
            for j in range(x.shape[1]):
                size = len(self.edges[j]) + 1
                left_g = np.cumsum(np.bincount(x[rows, j], g[rows], size))[:-1]
                left_h = np.cumsum(np.bincount(x[rows, j], h[rows], size))[:-1] + 1.0
                if len(left_g):
                    gain = left_g**2 / left_h + (total_g - left_g) ** 2 / (total_h - left_h + 2.0) - total_g**2 / total_h
                    k = int(gain.argmax())
                    best = max(best, (float(gain[k]), j, k))
        if best[1] < 0:
            tree[node] = (-1, 0, self.rate * total_g / total_h)
            return
        _, j, k = best
        tree[node] = (j, k, 0.0)
        low = x[rows, j] <= k
        self._grow(tree, 2 * node, rows[low], x, g, h, depth - 1)
        self._grow(tree, 2 * node + 1, rows[~low], x, g, h, depth - 1)

    def _tree(self, tree: dict, x: np.ndarray) -> np.ndarray:
        node, out = np.ones(len(x), np.int64), np.zeros(len(x))
        for _ in range(self.depth + 1):
            for number in np.unique(node):
                if number not in tree:
                    continue
                j, k, value = tree[int(number)]
                here = node == number
                if j < 0:
                    out[here], node[here] = value, 0
                else:
                    node[here] = 2 * number + (x[here, j] > k)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], 1)
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self._tree(tree, binned)
        return 1 / (1 + np.exp(-score))


# Patterns of sentences: ``<slot>`` is the value in question, ``{slot}`` any other part. The
# trees learn from the first family, thresholds are set on the second.
_TRUE = (
    (
        "{name}=<secret>", "{name} = \"<secret>\"", "{name}: <secret>", "{name}:'<secret>'", "\"{name}\": \"<secret>\",", "export {name}=<secret>", "the {name} is <mixed>",
        "<blob>", "{w} <keyed> {w}", "mail <spelled>", "{w} {w} <bracketed>", "write <spelled> {w}", "<bracketed>.", "IBAN <iban>", "{w} <iban> {w}", "{account} <iban>",
        "{phone}: <number>", "{phone} <number>", "{phone}. <number>", "{w} {phone} {w} <number>", "{account} <social>", "{account}: <social>", "{account} no. <document>", "{account} <document>", "{account} number <document>",
        "{account} number: <digits>", "{account} <digits>", "<social> {w}", "{account} {w} <digits>", "{phone} {w} {w} {w} <number>",
    ),
    (
        "{w} {name} => '<secret>'", "set {name} to = <secret>", "--{name}=<secret>", "{name}:<secret>;", "our {name} is \"<mixed>\"", "key <keyed>", "\n<blob>\n", "contact: <spelled>", "(<bracketed>)", "{w}, <spelled>, {w}",
        "pay to <iban>", "{account}: <iban>,", "{phone} me on <number>", "{phone} at <number> {w}", "{phone} {w} {w}: <number>", "{w} {account} is <social>", "his {account} was <document>", "{account} # <document>", "{account} {w} <social>",
        "{account} nr. <digits>", "the {account} is <digits>",
    ),
)
_FALSE = (
    (
        "in <year>", "year <year>", "version <version>", "v<version>", "chapter <version>", "{plain} <count>", "{plain} {w} <count>", "{w} <count> {w}", "<date>", "{w} <date>, {w}", "{plain} <hex>", "{plain}: <hex>", "the {name}: <word>", "this {name} is <word>", "{name}izer = <word>",
        "<joined>", "isbn <isbn>", "price <count>", "$<count>", "<figures>", "{w} at {w} dot {w}", "look at <word> dot {w}", "{w} <long>", "<upper>", "{phone} {w} {w} <year>", "{account} {w} in <year>", "{phone} <version>", "a {account} {w} <date>", "{plain} {plain} <social>", "{phone} {w} <date>", "{w} <wide>", "{plain} no. <document>", "{account} {w} <figures>", "{plain} {w} <number>", "{account} the <upper>", "{account} was <upper>",
    ),
    (
        "since <year>.", "{w} <version> {w}", "({plain} <count>)", "{plain} no. <count>", "on <date> {w}", "{plain} {w} <hex>", "my {name} is <word>", "{name}ation: <word>", "https://{w}/<joined>", "isbn: <isbn>", "€<count>", "<figures> {w}", "arrive at {w} dot {w}", "{account} <upper>", "{account} {w} {w} <year>", "{account} {w} <date>", "<long>", "{phone} {w} <year>, {w}", "between <count> and {w}", "{plain} <social>", "{plain}: <document>",
    ),
)
_SLOT = re.compile(r"<(\w+)>|\{(\w+)\}")


def labelled(rows: int, seed: int = 5, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of candidates in sentences of one family of patterns, half of them true."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    chars = lambda alphabet, n: "".join(alphabet[i] for i in rng.integers(len(alphabet), size=n))
    some = lambda a, b: int(rng.integers(a, b))
    digits, alnum, capitals = string.digits, string.ascii_letters + string.digits, string.ascii_uppercase
    filler = "the of and was to on for your my please or with der die und le la de el que".split()
    word = lambda: pick(filler) if some(0, 2) else "".join(chars("bcdfghlmnprstvw", 1) + chars("aeiou", 1) + pick(["", "", "n", "r", "s"]) for _ in range(some(1, 4)))

    def formed(*forms: str) -> str:
        return re.sub("#", lambda _: chars(digits, 1), pick(forms))

    def iban() -> str:
        country, rest = pick(["DE", "FR", "ES", "GB", "NL", "IT"]), chars(digits, some(14, 24))
        check = 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97
        v = f"{country}{check:02d}{rest}"
        return v if some(0, 2) else " ".join(v[i : i + 4] for i in range(0, len(v), 4))

    def name() -> str:
        own = pick(SECRET_WORDS)
        form = some(0, 8)
        if form == 0:
            return pick(["client", "access", "user", "db"]) + own.capitalize()
        if form == 1:
            return pick(["db", "my", "root", "app"]) + pick(["password", "passwd", "token", "secret", "apikey"])
        if form == 2:
            return pick(["client_", "DB_", "aws_", "the_own_name_of_a_"]) + pick([own, own.upper()])
        if form == 3:
            return own + pick(["_value", "_id", "_prod", "Key"])
        return own + "s" if form == 4 else own

    def mailbox() -> str:
        return word() + pick(["", "", f".{word()}", f"_{word()}", str(some(1, 99)), f".{some(1, 99)}"])

    def spelled(ats: list[str], dots: list[str]) -> str:
        return mailbox() + pick(ats) + word() + "".join(pick(dots) + x for x in [*[word() for _ in range(pick([0, 0, 1]))], pick(sorted(TOP_DOMAINS))])

    slots = {
        "w": word, "name": name, "phone": lambda: pick([str.lower, str.capitalize])(pick(PHONE_WORDS)), "account": lambda: pick([str.lower, str.upper, str.capitalize])(pick(ACCOUNT_WORDS)),
        "plain": lambda: pick(PLAIN_WORDS),
        "secret": lambda: pick([chars("0123456789abcdef", some(12, 48)), chars(alnum, some(8, 40)), chars(alnum + "!#$%&*", some(6, 24)), chars(alnum + "_-", some(40, 900)), word() + chars(digits, some(2, 5)) + pick(["", "!", "#"])]),
        "mixed": lambda: pick([word() + chars(digits, some(2, 5)), chars(alnum, some(8, 20)) + chars(digits, 2), word() + pick("!#$_-") + word().capitalize() + chars(digits, some(1, 4))]),
        "blob": lambda: pick(["eyJ", "MII", ""]) + chars(alnum + "+/", some(80, 900)) + pick(["", "=", "=="]),
        "keyed": lambda: pick([pick(["AKIA", "ASIA"]) + chars(capitals + "234567", 16), pick(["sk_live_", "pk_test_", "ghp_", "xoxb-", "AIza"]) + chars(alnum, some(20, 40))]),
        "spelled": lambda: spelled([" at ", " AT "], [" dot ", " DOT "]),
        "bracketed": lambda: spelled([" (at) ", "[at]", "(at)", " [at] ", "{at}", " <at> "], [" (dot) ", "[dot]", ".", " [dot] ", " dot "]),
        "iban": iban,
        "number": lambda: formed("(###) ###-####", "###-###-####", "### ### ####", "###/#######", "0# ## ## ## ##", "0### ######", "1-###-###-####", "0### ### ####", "6## ## ## ##", "### ####", "0##/######", "###.###.####"),
        "social": lambda: formed("###-##-####", "### ## ####"),
        "document": lambda: pick([chars(capitals, some(1, 3)) + chars(digits, some(6, 9)), chars(digits, 8) + chars(capitals, 1), chars(capitals + digits, 8) + chars(digits, 1), chars(capitals, 2) + formed(" ## ## ## ") + chars(capitals, 1)]),
        "digits": lambda: pick([chars(digits, some(7, 13)), formed("#### ####", "####-####-##", "######-#")]),
        "year": lambda: pick([str(some(1500, 2100)), f"{some(1900, 2000)}-{some(2000, 2030)}", f"{some(1900, 2000)}/{some(10, 99)}"]),
        "version": lambda: ".".join(str(some(0, 40)) for _ in range(some(2, 4))) + pick(["", "", f"-{some(1, 20_000)}"]),
        "count": lambda: pick([str(some(10_000, 10**12)), f"{some(1, 999)}.{some(100, 999)}.{some(100, 999)}", f"{some(1, 999)} {some(100, 999):03d} {some(100, 999)}", f"{some(1, 10**6)}.{some(0, 99):02d}"]),
        "date": lambda: pick([f"{some(1900, 2100)}-{some(1, 13):02d}-{some(1, 29):02d}", f"{some(1, 29)}.{some(1, 13)}.{some(1900, 2100)}", f"{some(1, 13):02d}/{some(1, 29):02d}/{some(1900, 2100)}", f"{some(1900, 2100)}-{some(1, 13):02d}-{some(1, 29):02d} {some(0, 24):02d}"]),
        "hex": lambda: chars("0123456789abcdef", pick([16, 20, 32, 40, 64])),
        "word": lambda: pick([word(), word() + word(), pick(["required", "wrong", "forgotten", "stored", "valid", "invalid", "expired", "missing"])]),
        "joined": lambda: pick("-_/").join(word() for _ in range(pick([some(4, 7), some(4, 7), some(12, 200)]))) + str(some(1, 2030)),
        "isbn": lambda: formed("978-#-##-######-#", "978##########", "978 # #### #### #"),
        "figures": lambda: (lambda top: " ".join(str(some(10, top)) for _ in range(some(3, 12))))(pick([99, 999, 9999])),
        "wide": lambda: "  ".join(f"{some(1, 999)}.{some(0, 99):02d}" for _ in range(some(3, 8))),
        "long": lambda: chars(digits, pick([some(8, 13), some(13, 20), some(20, 60)])),
        "upper": lambda: pick([f"{pick(['AB12', 'XY99', 'IT20'])} {' '.join(chars(capitals, 4) for _ in range(3))}", f"{some(10, 99)} {word().upper()} {word().upper()}", f"{word().upper()}-{some(1, 99)} {word().upper()}"]),
    }
    xs, ys = [], []
    while len(ys) < rows:
        truth = some(0, 2)
        pattern = pick((_TRUE if truth else _FALSE)[family])
        before = " ".join(word() for _ in range(some(0, 10))) + pick([" ", " ", " ", "\n", ". "])
        text, low, high, at = before, len(before), 0, 0
        for m in _SLOT.finditer(pattern):
            text += pattern[at : m.start()]
            value, at = slots[m[1] or m[2]](), m.end()
            if m[1]:
                low, high = len(text), len(text) + len(value)
            text += value
        # a pattern that is false as a whole has no slot of its own
        text += pattern[at:]
        high = high or len(text)
        text += pick([" ", ", ", ". ", "\n"]) + " ".join(word() for _ in range(some(1, 8)))
        for c in candidates_of(text):
            overlap = min(c.end, high) - max(c.start, low)
            if overlap > 0:
                xs.append(c.features)
                ys.append(float(truth and overlap >= 0.8 * max(c.end - c.start, high - low)))
    return np.array(xs[:rows]), np.array(ys[:rows])


def _united(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order and apart from each other."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


@dataclass
class Model:
    trees: Boosted
    thresholds: list[float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        found = candidates_of(text)
        if not found:
            return []
        p = self.trees.predict(np.array([c.features for c in found]))
        starts, ends = _united(base)
        out = []
        for i in sorted(range(len(found)), key=lambda i: (-p[i], found[i].start, -found[i].end)):
            c = found[i]
            at = bisect_left(starts, c.end)  # the last taken span that begins before the candidate ends
            if p[i] >= self.thresholds[c.generator] and (not at or ends[at - 1] <= c.start):
                starts.insert(at, c.start)
                ends.insert(at, c.end)
                out.append((c.start, c.end, GENERATORS[c.generator][0]))
        return out

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans in order."""
        base = base_spans(text)
        return base, sorted(base + self.added(text, base), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def train(rows: int = TRAIN_ROWS, seed: int = 5, precision: float = PRECISION) -> Model:
    """Fit on two thirds of the labelled rows, set each generator's threshold on the rest.

    The rest comes from the other family of patterns. A generator that doesn't reach the
    precision there takes the threshold of the best it reaches.
    """
    cut = 2 * rows // 3
    trees = Boosted().fit(*labelled(cut, seed))
    x, held = labelled(rows - cut, seed + 1, family=1)
    p, generator = trees.predict(x), x[:, 0]
    thresholds = []
    for g in range(len(GENERATORS)):
        own, truth = p[generator == g], held[generator == g]
        order = np.argsort(-own, kind="stable")
        right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(right >= min(precision, right.max(initial=0)))
        # not below an even chance
        thresholds.append(max(0.5, float(own[order[enough[-1]]])) if len(enough) else 0.5)
    return Model(trees, thresholds)


def told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find(docs: DataFrame, text: str = "text", model: Model | None = None, keep: list[str] | None = None) -> DataFrame:
    """row (the document's own columns, or those to ``keep``), n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted."""
    model = model or train()
    rows = docs.select(hidden(docs if keep is None else docs.select(*keep)), text_of(f"`{text}`").alias("text"))
    names = ["row", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "redacted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column("text").to_pylist()
                found = [model.spans(t) for t in texts]
                counts = [Counter(k for _, _, k in base) for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        *[pa.array([c[k] for c in counts], pa.int64()) for k in BASE_KINDS],
                        pa.array([hashlib.sha256(told(base).encode()).hexdigest() for base, _ in found]),
                        pa.array([told(every) for _, every in found]),
                        pa.array([redact(t, every) for t, (_, every) in zip(texts, found)], pa.string()),
                    ],
                    names,
                )

    row_type = rows.schema["row"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    return rows.mapInArrow(run, f"row {row_type}, {counts}, base_sha256 string, spans string, redacted string")


def redact(text: str, spans: list[Span]) -> str:
    """The text with a mark of its kind in place of each span; overlapping ones become one."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
