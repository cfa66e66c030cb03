"""Personal data by weak supervision.

Patterns propose candidate spans. Labellers (regular expressions, gazetteers, context) vote on
each; expectation-maximisation over the votes of all candidates estimates how reliable they are,
and the posterior trains a hashed span classifier. Base spans, which patterns and checks define,
always stay; the classifier decides on the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeline.llm.common import Stored, map_texts, quoted, to_batch
from gradeline.llm.linear import BUCKETS, bounded_sample, bucket, fit_logistic, sigmoid
from gradeline.llm.weak import VoteModel, fit_from

SAMPLE_ROWS = 10_000
LEAST_CHANCE = 0.5
AROUND = 40
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "email_words", "phone_local", "national_id", "iban", "name")
LABELLERS = ("format", "gazetteer", "context", "counter_context", "digits", "edges")

# The patterns of the base kinds, with possessive digits where going back cannot
# help, and the bounds on what they find.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, LARGEST_PART = (16, 19), (8, 15), 255
# The patterns of the further candidates.
_MORE = {
    "email_words": re.compile(
        r"(?<![\w.])[A-Za-z0-9._-]{2,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{2,63}"
        r"(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,63}){1,4}"
    ),
    "phone_local": re.compile(r"(?<![\w+(.-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![\w-])"),
    "national_id": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b"),
    "name": re.compile(
        r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20[A-ZÀ-Þ][a-zß-ÿ]+(?:\x20[A-ZÀ-Þ][a-zß-ÿ]+)?"
    ),
}
# Gazetteers and words of context.
TOP_DOMAINS = frozenset("com org net edu gov io info biz de fr es it uk us ca eu ch at nl be pl se".split())
FIRST_NAMES = frozenset(
    "james john robert michael david maria anna peter paul thomas laura julia marie pierre jean luis carlos "
    "juan hans klaus petra sabine sophie camille carmen elena".split()
)
COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "teléfono", "anruf"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "ip": ("ip", "address", "host", "server", "login"),
    "national_id": ("ssn", "social", "security", "identity"),
    "iban": ("iban", "account", "konto", "bank"),
    "name": ("dear", "by", "from", "with", "patient", "signed"),
}
COUNTER_CONTEXT = ("version", "order", "invoice", "part", "isbn", "build", "section", "figure", "serial", "release")
_WORD = re.compile(r"\w+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(digits)):
        value = int(char)
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What the pattern of addresses finds, by looking outward from each ``@``."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then by start; each kind leftmost and non-overlapping."""
    spans = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= LARGEST_PART for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if CARD_DIGITS[0] <= m.end() - m.start() <= 2 * CARD_DIGITS[1]:
            digits = _digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
                spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
            spans.append(("phone", *m.span()))
    return spans


def further_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates of the other kinds that touch no base span, by kind, then by start."""
    covered = sorted((start, end) for _, start, end in base)
    starts = [start for start, _ in covered]
    spans = []
    for kind, pattern in _MORE.items():
        for m in pattern.finditer(text):
            near = int(np.searchsorted(starts, m.end(), "left"))
            if all(end <= m.start() for _, end in covered[max(0, near - 4) : near]):
                spans.append((kind, *m.span()))
    return spans


def _root(kind: str) -> str:
    return {"email_words": "email", "phone_local": "phone"}.get(kind, kind)


def vote(text: str, kind: str, start: int, end: int) -> list[int]:
    """One vote of each labeller: 1 personal, -1 not, 0 none."""
    span, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - AROUND) : start].lower()
    around = set(_WORD.findall(before + " " + text[end : end + AROUND].lower()))
    root = _root(kind)
    if root == "email":
        form = 1 if re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", span) else 0
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", span)[-1].lower() in TOP_DOMAINS else -1
    elif root == "phone":
        form = 1 if len(digits) in (10, 11, 12) and re.search(r"[() .-]", span) else -1 if len(digits) < 10 else 0
        gazetteer = -1 if digits[-10:-7].startswith(("0", "1")) else 0
    elif root == "card":
        form = 1 if len(digits) == 16 else 0
        gazetteer = 1 if digits[0] in "3456" else -1
    elif root == "ip":
        first = span.split(".")[0]
        form = 1 if all(str(int(p)) == p for p in span.split(".")) else -1
        gazetteer = -1 if first in ("0", "127", "255") else 0
    elif root == "iban":
        form = 1 if 15 <= len(span.replace(" ", "")) <= 34 else -1
        gazetteer = 1 if span[:2] in COUNTRIES else -1
    elif root == "national_id":
        form = -1 if span.startswith(("000", "666", "9")) or span[4:6] == "00" else 1
        gazetteer = 0
    else:
        form = 1 if span.count(" ") == 2 else 0
        gazetteer = 1 if FIRST_NAMES & set(span.lower().split()) else 0
    context = 1 if any(word.startswith(CONTEXT[root]) for word in around) else 0
    counter = -1 if any(word.startswith(COUNTER_CONTEXT) for word in around) else 0
    dull = -1 if digits and len(set(digits)) <= 2 and len(digits) >= 6 else 0
    embedded = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return [form, gazetteer, context, counter, dull, -1 if embedded else 1]


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """Hashed features of a span: its kind, its shape and the words round it."""
    shape = re.sub(r"[A-Z]+", "A", re.sub(r"[a-z]+", "a", re.sub(r"[0-9]", "0", text[start:end])))[:24]
    before = _WORD.findall(text[max(0, start - AROUND) : start].lower())[-3:]
    after = _WORD.findall(text[end : end + AROUND].lower())[:2]
    left, right = text[max(0, start - 1) : start], text[end : end + 1]
    names = [f"kind {kind}", f"shape {kind} {shape}", f"left {kind} {left.isalnum()}", f"right {kind} {right.isalnum()}"]
    names += [f"before {word}" for word in before] + [f"after {word}" for word in after]
    return [bucket(name) for name in names]


@dataclass(frozen=True)
class SpanModel:
    votes: VoteModel
    weights: np.ndarray
    bias: float

    def chance(self, found: list[int]) -> float:
        return float(sigmoid(np.float64(self.weights[found].sum() + self.bias)))


def candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``votes, features, place`` of every candidate; ``place`` tells equal ones apart."""
    schema = StructType.fromDDL("votes array<int>, features array<int>, place string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text) if text else []
                for kind, start, end in base + (further_spans(text, base) if text else []):
                    place = f"{start} {text[max(0, start - 20) : end + 20]}"
                    rows.append((vote(text, kind, start, end), features(text, kind, start, end), place))
            yield to_batch(schema, list(zip(*rows, strict=True)) if rows else [[], [], []])

    return df.select(quoted(text_col).cast("string")).mapInArrow(run, schema)


def fit_spans(df: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> SpanModel:
    """Reliabilities from the votes on all candidates; the classifier from at most ``sample_rows``.

    The sample is that of the least hashes, half of it of each side of the posterior if there are
    as many. Candidates are few beside the texts and are stored once.
    """
    stored = Stored(candidates(df, text_col))
    model = fit_from(stored.df, "votes", len(LABELLERS))
    patterns = [row["votes"] for row in stored.df.select("votes").distinct().collect()]
    if not patterns:
        return SpanModel(model, np.zeros(BUCKETS), 0.0)
    belief = model.posterior(np.array(patterns, dtype=np.int64))
    sides = [(p, int(b >= 0.5)) for p, b in zip(patterns, belief, strict=True)]
    # One row per pattern of votes: at most 3 ** labellers.
    known = F.broadcast(df.sparkSession.createDataFrame(sides, "votes array<int>, side int"))
    rows = bounded_sample(stored.df.join(known, "votes"), "side", ["place"], sample_rows // 2)
    stored.drop()
    targets = model.posterior(np.array([r["votes"] for r in rows], dtype=np.int64))
    found = [np.array(r["features"]) for r in rows]
    return SpanModel(model, *fit_logistic(found, [np.ones(len(f)) for f in found], targets))


def find_personal(
    df: DataFrame,
    model: SpanModel,
    text_col: str = "text",
    keep: list[str] | None = None,
    least: float = LEAST_CHANCE,
) -> DataFrame:
    """Each row with its personal data.

    Added columns: ``kinds`` (array of string), ``starts``, ``ends`` (arrays of int, code points,
    end exclusive), ``chances`` (array of double, the classifier's), ordered by kind as listed in
    ``KINDS`` and then by start. Base spans are there whatever their chance, further ones from
    ``least`` on. A null or empty text has none. Rows are independent; an empty table gives an
    empty result; an input column of a result's name is replaced. Nothing is shuffled.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def work(texts):
            out: tuple[list, ...] = ([], [], [], [])
            for text in texts:
                base = base_spans(text) if text else []
                spans = [(*s, model.chance(features(text, *s))) for s in base]
                for span in further_spans(text, base) if text else []:
                    chance = model.chance(features(text, *span))
                    if chance >= least:
                        spans.append((*span, chance))
                for column, values in zip(out, zip(*spans, strict=True) if spans else ([],) * 4, strict=True):
                    column.append(list(values))
            return out

        return work

    return map_texts(df, text_col, "kinds array<string>, starts array<int>, ends array<int>, chances array<double>", make, keep)
