"""Personal data by weakly supervised span detection.

Candidates are found by fixed patterns.  The base kinds (email, ip, card, phone)
follow their contract exactly and always stay.  Looser candidates (obfuscated
addresses, phone numbers without a country sign, numbers beside a word such as
"card", keys and hashes, titled names) are judged, also where they overlap:
regular-expression, gazetteer and context labelers vote for or against each or
abstain, expectation-maximisation over all candidates of the corpus, the base
spans among them as sure cases, estimates how reliable each labeler is, and the
posteriors of the looser ones train a
logistic span classifier on the votes' features, which has the last word.  Of
accepted spans that overlap the likelier stays, then the longer, then the first.

What is gathered from the corpus is one count for each kind and pattern of votes,
a table of bounded size; no candidate or text goes to the driver.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .label_model import LabelModel

#: The base kinds in the order of their listing, then the others.
BASE = ("email", "ip", "card", "phone")
ADDED = ("masked_email", "local_phone", "number", "secret", "name")
KINDS = BASE + ADDED

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# starting inside a run of digits can't match where its first digit doesn't
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT, _DOT = (rf"(?:\({w}\)|\[{w}\]|\{{{w}\}}| {w} )" for w in ("at", "dot"))
# a run is taken whole or not at all, so that no text takes more than linear time
_MASKED = re.compile(rf"(?<![\w.%+-])[A-Za-z0-9._%+-]++ ?{_AT} ?[A-Za-z0-9-]++(?: ?{_DOT} ?[A-Za-z]{{2,}}+)+(?!\w)", re.I)
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w.-])")
_SECRET = re.compile(r"[A-Za-z0-9_]{20,}")
_DIGIT = re.compile(r"[0-9]")
_OTHER = re.compile(r"[^0-9]+")
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Dra", "Prof", "Herr", "Frau", "Mme", "Mlle", "Sr", "Sra", "Srta")
_NAME = re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.? [A-ZÀ-Ý][a-zß-ÿ]++(?: [A-ZÀ-Ý][a-zß-ÿ]++)?(?!\w)")

#: Gazetteers of the voters.
TOP_DOMAINS = frozenset(
    "ai ar at au be biz br ca ch cl cn co com cz de dev dk edu es eu fi fr gov gr hu ie in info int io it jp kr lu me mil mx net nl no nz org pl pt "
    "ro ru se sg sk tr tv uk us za".split()
)
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "90", "91")
CARD_FIRST = "23456"
FIRST_NAMES = frozenset(
    "ada adam alan alice amy ana andrea andrew angela ann anna anne antonio barbara ben brian bruno carlos carmen carol charles charlotte chris "
    "christian christine claire clara claude daniel david diana diego donald dorothy edward elena elizabeth emily emma eric eva felix fernando "
    "francis frank franz fritz gabriel george gerda greta hans heinz helen helga henri henry hugo ian ines ingrid isabel jack jacques jaime james "
    "jan jane jason javier jean jennifer jens joan john jorge jose joseph juan julia julie jutta karen karl kate klaus laura lena linda lisa louis "
    "lucas lucia luis luise manuel marco margaret maria marie mark marta martin mary matthew max michael miguel monika nancy nicolas nina olga "
    "otto pablo patricia paul pedro peter petra philip pierre rafael ralf ramon richard robert rosa ruth sandra sarah simon sofia sophie stefan "
    "susan sven theo thomas tim ursula uwe vera victor walter werner william wolfgang".split()
)
CUES = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "karte", "carte", "tarjeta", "credit"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "ruf", "appel"),
    "secret": ("key", "token", "secret", "password", "passwd", "api"),
    "name": ("name", "signed", "dear", "sincerely", "regards"),
}
CUE_OF = {"masked_email": "email", "local_phone": "phone", "number": "card"}
AGAINST = ("isbn", "version", "order", "page", "chapter", "license", "commit", "revision")
#: Characters on either side in which a context voter looks for its cues.
REACH = 32

#: How often a card's check digit is right about it: arithmetic, not to be learnt.
CHECKSUM_TRUST = 0.99
LABELERS = ("company", "checksum", "gazetteer", "cue", "counter_cue", "shape")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans, by kind as listed, then by start; ends are exclusive."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _digits(run: str) -> str:
    return _OTHER.sub("", run)


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Looser spans that touch no base span, by kind, then by start."""
    taken = sorted((s, e) for _, s, e in base)
    found = []

    def offer(kind, pattern, keep=lambda s: True):
        for m in pattern.finditer(text):
            if keep(m[0]):
                found.append((kind, *m.span()))

    # plain searches first: most texts can't hold most kinds
    if "dot" in text.lower():
        offer("masked_email", _MASKED)
    if _DIGIT.search(text):
        offer("local_phone", _LOCAL_PHONE)
        offer("number", _CARD, lambda s: 13 <= len(_digits(s)) <= 19)
        offer("secret", _SECRET, lambda s: any(c.isdigit() for c in s) and any(c.isalpha() for c in s))
    if any(t in text for t in TITLES):
        offer("name", _NAME)
    free, k = [], 0
    for kind, s, e in sorted(found, key=lambda x: (x[1], x[2])):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if not (k < len(taken) and taken[k][0] < e):
            free.append((kind, s, e))
    return sorted(free, key=lambda x: (KINDS.index(x[0]), x[1]))


#: Characters to the next base span within which a span has company.
COMPANY = 64


def in_company(span: tuple[str, int, int], base: list[tuple[int, int]]) -> bool:
    """Whether another base span lies near; ``base`` holds their ends in order."""
    _, s, e = span
    k = bisect_left(base, (s, e))
    near = [x for x in base[max(0, k - 1) : k + 2] if x != (s, e)]
    return any(x[0] - e < COMPANY and s - x[1] < COMPANY for x in near)


def votes(text: str, span: tuple[str, int, int], base: Sequence[tuple[int, int]] = ()) -> tuple[int, ...]:
    """One vote of each labeler on a span; ``base``: where the text's base
    spans are, in order."""
    kind, s, e = span
    body = text[s:e]
    digits = "".join(c for c in body if "0" <= c <= "9") if e - s <= 4096 else ""
    around = (text[max(0, s - REACH) : s] + " " + text[e : e + REACH]).lower()
    subject = CUE_OF.get(kind, kind)
    company = 1 if in_company(span, base) else 0
    checksum = gazetteer = shape = 0
    if subject == "email":
        gazetteer = 1 if re.split(r"[.\s)\]}]+", body.lower())[-1] in TOP_DOMAINS else -1
        shape = 1 if 5 < e - s < 80 and ".." not in body else -1
    elif subject == "ip":
        checksum = 1 if len(digits) >= 6 else -1
        shape = -1 if text[s - 1 : s].isalnum() or text[e : e + 1].isalnum() or text[e : e + 2].startswith(".") and text[e + 1 : e + 2].isdigit() else 1
    elif subject == "card":
        checksum = 1 if luhn(digits) and len(set(digits)) > 2 else -1
        gazetteer = 1 if digits[:1] in CARD_FIRST else -1
        shape = -1 if text[s - 1 : s].isalnum() or text[e : e + 1].isalnum() else 1
    elif subject == "phone":
        # without a country: a trunk prefix, or ten digits as in North America
        national = digits.startswith("0") or (len(digits) == 10 and digits[0] in "23456789")
        gazetteer = 1 if (national if kind == "local_phone" else digits.startswith(CALLING_CODES)) else -1
        shape = 1 if 9 <= len(digits) <= 12 and body.count("(") == body.count(")") else -1
    elif subject == "secret":
        # keys are drawn from many characters, hashes are hexadecimal; names and numbers repeat a few
        checksum = 1 if len(set(body)) >= 12 or (len(body) >= 32 and re.fullmatch("[0-9a-f]+|[0-9A-F]+", body)) else -1
        kinds = sum(any(f(c) for c in body) for f in (str.isdigit, str.islower, str.isupper))
        shape = 1 if len(digits) * 5 >= len(body) and kinds >= 2 else -1
        gazetteer = 1 if body.lower().startswith(("sk_", "ghp_", "akia", "xox")) else 0
    elif subject == "name":
        gazetteer = 1 if any(w.lower() in FIRST_NAMES for w in body.split()) else 0
        shape = 1 if body.count(" ") >= 2 else 0
    cue = 1 if any(c in around for c in CUES[subject]) else 0
    counter = -1 if any(c in around for c in AGAINST) else 0
    return company, checksum, gazetteer, cue, counter, shape


class SpanModel:
    """Label models by subject and one logistic classifier over all kinds."""

    def __init__(self, rounds: int = 400, ridge: float = 1e-2):
        self.rounds, self.ridge = rounds, ridge
        self.weights = np.zeros(self._features("email", (0,) * len(LABELERS)).shape)
        self.reliability: dict[str, np.ndarray] = {}

    @staticmethod
    def _features(kind: str, vote: tuple[int, ...]) -> np.ndarray:
        kinds = np.array([float(kind == k) for k in KINDS])
        return np.concatenate([kinds, [float(v > 0) for v in vote], [float(v < 0) for v in vote]])

    def fit(self, counts: dict[tuple[str, tuple[int, ...]], int]) -> SpanModel:
        """``counts``: candidates of each kind and vote pattern."""
        if not counts:
            return self
        soft = {}
        for subject in dict.fromkeys(CUE_OF.get(k, k) for k in KINDS):
            own = [(x, n) for x, n in counts.items() if CUE_OF.get(x[0], x[0]) == subject]
            if own:
                sure = np.array([x[0] in BASE for x, _ in own])
                model = LabelModel(len(LABELERS), smoothing=5.0, trust={LABELERS.index("checksum"): CHECKSUM_TRUST} if subject == "card" else None).fit([x[1] for x, _ in own], [n for _, n in own], sure)
                self.reliability[subject] = model.accuracies()
                soft.update(zip([x for x, _ in own], model.posterior([x[1] for x, _ in own])))
        # base spans were sure cases for the labelers; the classifier judges the others
        keys = sorted(k for k in counts if k[0] not in BASE)
        if not keys:
            return self
        x = np.stack([self._features(*k) for k in keys])
        y = np.array([soft[k] for k in keys])
        # the logarithm keeps a frequent kind from drowning the others
        n = np.log1p(np.array([counts[k] for k in keys], dtype=float))
        n /= n.sum()
        w = self.weights
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-x @ w))
            gradient = x.T @ (n * (p - y)) + self.ridge * w / len(keys)
            hessian = (x.T * (n * p * (1 - p) + 1e-9)) @ x + (self.ridge / len(keys) + 1e-6) * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w = w - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        return self

    def chance(self, kind: str, vote: tuple[int, ...]) -> float:
        """How likely a span is personal data: base kinds surely."""
        return 1.0 if kind in BASE else float(1 / (1 + np.exp(-self._features(kind, vote) @ self.weights)))

    def keeps(self, kind: str, vote: tuple[int, ...], threshold: float = 0.5) -> bool:
        """Base kinds always; others by the classifier."""
        return self.chance(kind, vote) >= threshold


def learn(docs: DataFrame, text: str = "text") -> SpanModel:
    """A model from every candidate of every text in ``docs``."""

    def counted(batches):
        seen: Counter = Counter()
        for pdf in batches:
            for t in pdf["t"]:
                if t:
                    base = base_spans(t)
                    places = sorted(x[1:] for x in base)
                    seen.update((span[0], votes(t, span, places)) for span in base + candidates(t, base))
        rows = [(k, "".join("-0+"[v + 1] for v in vote), n) for (k, vote), n in seen.items()]
        yield pd.DataFrame(rows, columns=["kind", "votes", "n"]).astype({"n": "int64"})

    found = docs.select(F.col(text).cast("string").alias("t")).mapInPandas(counted, "kind string, votes string, n long")
    table = found.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()  # at most kinds x 3^labelers rows
    return SpanModel().fit({(r.kind, tuple("-0+".index(v) - 1 for v in r.votes)): r.n for r in table})


def find_spans(text: str, model: SpanModel, decided: dict | None = None) -> tuple[list, list]:
    """Base spans, and all spans: base and accepted others, by kind as listed,
    then by start."""
    base = base_spans(text)
    places = sorted(x[1:] for x in base)
    decided = {} if decided is None else decided
    likely = []
    for span in candidates(text, base):
        key = (span[0], votes(text, span, places))
        if key not in decided:
            decided[key] = model.chance(*key)
        if decided[key] >= 0.5:
            likely.append((-decided[key], span[1] - span[2], span[1], span))
    extra, taken = [], []
    for *_, span in sorted(likely):
        k = bisect_left(taken, span[1:])
        if (k == 0 or taken[k - 1][1] <= span[1]) and (k == len(taken) or taken[k][0] >= span[2]):
            taken.insert(k, span[1:])
            extra.append(span)
    return base, base + sorted(extra, key=lambda x: (KINDS.index(x[0]), x[1]))


def listing(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def detect(docs: DataFrame, model: SpanModel | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, counts of base spans, ``base_sha256`` of their
    listing, ``spans``, the listing of all spans as kind:start:end in code
    points, and counts of the added ones by kind and of all (``n_spans``).

    Null and empty texts have no spans (and the digest of the empty string).
    Equal ids or texts each give a row, an empty table gives none, further
    columns are not used."""
    model = model or learn(docs, text)

    shown = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", *[f"n_{k}" for k in ADDED], "n_spans"]

    @F.pandas_udf(", ".join(f"{c} {'long' if c.startswith('n_') else 'string'}" for c in shown))
    def spans(texts: pd.Series) -> pd.DataFrame:
        rows, decided = [], {}
        for t in texts:
            base, every = find_spans(t or "", model, decided)
            kinds = Counter(k for k, _, _ in every)
            digest = hashlib.sha256(listing(base).encode()).hexdigest()
            rows.append((*(kinds[k] for k in BASE), digest, listing(every), *(kinds[k] for k in ADDED), len(every)))
        return pd.DataFrame(rows, columns=shown)

    found = docs.select(F.col(id_column).alias("doc_id"), spans(F.col(text).cast("string")).alias("s"))
    return found.select(F.col("doc_id").alias(id_column), "s.*")


def redact(docs: DataFrame, model: SpanModel | None = None, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle
    brackets, and ``n_chars``, if there is such a column, counted anew where the
    text changed.  A null text stays null."""
    model = model or learn(docs, text)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        out, decided = [], {}
        for t in texts:
            if t:
                parts, at = [], 0
                for kind, s, e in sorted(find_spans(t, model, decided)[1], key=lambda x: (x[1], -x[2])):
                    if e > at:
                        parts.append(t[at : max(s, at)] + ("" if s < at else f"<{kind}>"))
                        at = e
                t = "".join(parts) + t[at:]
            out.append(t)
        return pd.Series(out, dtype=object)

    (new,) = fresh(docs, "redacted")
    out = docs.withColumn(new, cleaned(F.col(text).cast("string")))
    if n_chars in docs.columns:
        changed = ~F.col(new).eqNullSafe(F.col(text).cast("string"))
        out = out.withColumn(n_chars, F.when(changed, F.char_length(new)).otherwise(F.col(n_chars)).cast(docs.schema[n_chars].dataType))
    return out.withColumn(text, F.col(new)).drop(new)
