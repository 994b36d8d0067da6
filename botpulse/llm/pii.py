"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base kinds (email, ip, card, phone) are fixed patterns and always stay. The method adds spans of the
kinds account, person, mailto (an email in words) and iban (with right check digits). Candidates of all kinds, base ones included, get the
votes (+1, 0, -1) of six labelers: strict pattern, check digit, gazetteer, context words, digit grouping,
and personal data nearby.

*EM.* All candidates of the corpus are counted by vote pattern (at most 3^6 rows). Expectation-
maximisation of a two-class model with independent labelers on these counts estimates the share
of real personal data and each labeler's reliability, hence a probability per pattern.

*Classifier.* Those probabilities are the soft labels of a logistic regression over the candidates'
features (kind, number of digits, separators, context, neighbours, check digit, known name or title: at most ``CELLS``
different cells, counted the same way). It is trained by Newton steps on the counted cells, which is exact for all candidates, and
accepts or rejects each cell.

Both counts cover every text; only these bounded tables reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botpulse.llm.common import staged, text_of

KINDS = ("email", "ip", "card", "phone", "account", "person", "mailto", "iban")
N_BASE = 4
LABELERS = ("pattern", "checksum", "gazetteer", "context", "grouping", "nearby")

# Common first names of the four languages, titles and context words. Longer lists go in as ``names=``.
FIRST_NAMES = frozenset((
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Steven Paul "
    "Andrew Kevin Brian George Edward Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Emily "
    "Margaret Sandra Ashley Emma Olivia Rachel Laura Helen "
    "Hans Klaus Jürgen Juergen Wolfgang Peter Stefan Andreas Matthias Uwe Dieter Heinz Karl Günter Jonas Lukas Felix Ursula "
    "Monika Sabine Petra Gabriele Renate Birgit Andrea Claudia Katrin Heike Anke Hannah Lena Anna Lea "
    "Pierre Jean Jacques Michel Philippe Alain Nicolas Laurent Julien François Luc Antoine Mathieu Guillaume Hugo Marie Claire "
    "Sophie Nathalie Isabelle Catherine Camille Céline Élodie Chloé Manon Juliette Amélie Louise Brigitte "
    "Juan Carlos José Jose Luis Antonio Manuel Francisco Javier Miguel Pedro Alejandro Fernando Diego Pablo Sergio Jorge Rafael "
    "Maria María Carmen Lucia Lucía Ana Isabel Dolores Pilar Teresa Rosa Cristina Marta Elena Sofía Paula").split())
HONORIFICS = frozenset("Mr Mr. Mrs Mrs. Ms Ms. Dr Dr. Prof Prof. Sir Herr Herrn Frau Monsieur Madame Mademoiselle Mme Mlle Me "
                       "Señor Señora Señorita Sr. Sra. Srta. Don Doña".split())
FOR = re.compile(r"(?i)\b(?:phone|tel|telefon|handy|mobil|teléfono|móvil|téléphone|portable|call|mobile|fax|email|e-mail|mail|correo|"
                 r"courriel|card|carte|karte|kreditkarte|tarjeta|iban|konto|kontonummer|account|compte|cuenta|contact|kontakt|"
                 r"contacto|name|nom|nombre|ssn|passport|passnummer|passeport|pasaporte|kundennummer|patient|customer|client|"
                 r"cliente|kunde|signed|dear|regards|liebe|lieber|cher|chère|querido|querida)\b")
AGAINST = re.compile(r"(?i)\b(?:version|isbn|issn|order|page|chapter|figure|table|year|doi|build|port|rev|section|invoice|ticket|"
                     r"issue|serial|seite|kapitel|jahr|bestellung|rechnung|página|capítulo|año|pedido|factura|chapitre|"
                     r"année|commande|facture)\b")
REACH, NEAR = 30, 60  # characters of context before a candidate; distance to other personal data

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAILTO = re.compile(r"(?i)\b[a-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[a-z0-9-]{1,63} ?(?:\(dot\)|\[dot\]| dot ) ?[a-z]{2,10}\b")
_NAME = re.compile(r"[^\W\d_]+")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the check digits of an account number in international form are right."""
    body = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from each @ outwards."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        else:
            free = max(free, at + 1)  # no later start before this @ can succeed
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans (kind, start, end), and the digit runs that are no cards."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    runs = []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _DIGITS.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
        elif 7 <= len(d) <= 19:
            runs.append((m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out, runs


def names(text: str, known: frozenset = FIRST_NAMES) -> list[tuple[int, int]]:
    """A title or a known first name and the capitalised words behind it."""
    words = set(text.split())
    found = []
    for head in (words & known) | (words & HONORIFICS):
        at = text.find(head)
        while at >= 0:
            end = at + len(head)
            if (at == 0 or text[at - 1].isspace()) and text[end:end + 1] == " ":
                stop = end
                while text[stop:stop + 1] == " " and (m := _NAME.match(text, stop + 1)) and m[0][0].isupper() and len(m[0]) > 1:
                    stop = m.end()
                if stop > end:
                    found.append((at, stop))
            at = text.find(head, end)
    out: list[tuple[int, int]] = []
    for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def _bucket(n: int) -> int:
    return 0 if n == 0 else 1 if n < 7 else 2 if n < 10 else 3 if n < 13 else 4 if n < 17 else 5


_SIZES = (len(KINDS), 6, 3, 3, 2, 3, 3)  # kind, digits, separators, context, neighbour, check digit, known name or title
CELLS = int(np.prod(_SIZES))


def candidates(text: str, known: frozenset = FIRST_NAMES) -> tuple[list[tuple], list[tuple]]:
    """Base spans, and all candidates as (kind, start, end, vote pattern, cell)."""
    has_digit = re.search("[0-9]", text) is not None
    base, runs = base_spans(text) if has_digit or "@" in text else ([], [])
    ibans = [(7, m.start(), m.end()) for m in _IBAN.finditer(text) if mod97(m[0])] if has_digit else []
    more = ibans + [(4, a, b) for a, b in runs if not any(a < j and i < b for _, i, j in ibans)]
    more += [(5, a, b) for a, b in names(text, known)]
    lower = text.lower()
    if " at " in lower or "(at)" in lower or "[at]" in lower:
        more += [(6, m.start(), m.end()) for m in _MAILTO.finditer(text)]
    if more and base:
        taken = bytearray(len(text))
        for _, a, b in base:
            taken[a:b] = b"\1" * (b - a)
        more = [s for s in more if not any(taken[s[1]:s[2]])]
    spans = base + more
    order = sorted(spans, key=lambda s: (s[1], s[2], s[0]))
    out = []
    for i, (kind, a, b) in enumerate(order):
        body = text[a:b]
        d = _digits(body)
        seps = len(set(body) & set(" -.()"))
        before = text[max(0, a - REACH):a]
        context = 1 if FOR.search(before) else -1 if AGAINST.search(before) else 0
        near = any(0 <= j < len(order) and min(abs(order[j][1] - b), abs(a - order[j][2])) <= NEAR for j in (i - 1, i + 1))
        words = body.split() if kind == 5 else []
        title, named = bool(words) and words[0] in HONORIFICS, not known.isdisjoint(words)
        check = 1 if kind == 7 else 0 if not 13 <= len(d) <= 19 or kind in (0, 1, 3) else 1 if luhn(d) else -1
        votes = (
            1 if kind < N_BASE or title else -1 if kind == 4 else 0,
            check,
            1 if named or kind == 0 else 0,
            context,
            -1 if d and (len(set(d)) == 1 or d in "01234567890123456789") else 1 if kind in (2, 3, 4, 7) and seps else 0,
            1 if near else 0,
        )
        pattern = sum((v + 1) * 3 ** k for k, v in enumerate(votes))
        cell = int(np.ravel_multi_index((kind, _bucket(len(d)), min(seps, 2), context + 1, int(near), check + 1,
                                         named + 2 * title if not (named and title) else 1), _SIZES))
        out.append((kind, a, b, pattern, cell))
    return base, out


def em(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray, float]:
    """Probability per vote pattern, the labelers' vote probabilities [class, labeler, vote], and the prior."""
    if not counts:
        return {}, np.full((2, len(LABELERS), 3), 1 / 3), 0.5
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    votes = np.array([[p // 3 ** k % 3 for k in range(len(LABELERS))] for p in patterns])
    total = (votes - 1).sum(axis=1)
    post = 1 / (1 + np.exp(-2.0 * total))  # start: the majority
    hot = np.eye(3)[votes]
    for _ in range(rounds):
        prior = float(np.clip((n * post).sum() / n.sum(), 1e-6, 1 - 1e-6))
        table = np.stack([((n * w)[:, None, None] * hot).sum(axis=0) + 0.5 for w in (1 - post, post)])
        table /= table.sum(axis=2, keepdims=True)
        logs = np.log(table)
        score = [np.log(q) + (hot * logs[c]).sum(axis=(1, 2)) for c, q in ((0, 1 - prior), (1, prior))]
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        moved = float(np.abs(new - post).max())
        post = new
        if moved < 1e-9:
            break
    return dict(zip(patterns, post.tolist())), table, prior


def _design(cells: list[int]) -> np.ndarray:
    parts = np.unravel_index(np.array(cells, int), _SIZES)
    return np.hstack([np.ones((len(cells), 1))] + [np.eye(k)[p] for k, p in zip(_SIZES, parts)])


def train(cells: list[int], n: np.ndarray, target: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression on counted cells with soft targets (Newton's method)."""
    x = _design(cells)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (target - p)) - ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-10:
            break
    return w


def fit(found: DataFrame) -> dict:
    """The model of the corpus whose candidates ``found`` holds."""
    rows = (found.select(F.explode("candidates").alias("c")).groupBy("c.cell", "c.pattern")
            .agg(F.count("*").alias("n")).collect())  # at most CELLS * 3^6 rows, in practice a few hundred
    by_pattern: dict[int, int] = {}
    for r in rows:
        by_pattern[r.pattern] = by_pattern.get(r.pattern, 0) + r.n
    posterior, reliability, prior = em(by_pattern)
    sums: dict[int, list[float]] = {}
    for r in sorted(rows, key=lambda r: (r.cell, r.pattern)):
        s = sums.setdefault(r.cell, [0.0, 0.0])
        s[0] += r.n
        s[1] += r.n * posterior[r.pattern]
    cells = sorted(sums)
    accepted: list[int] = []
    if cells:
        n = np.array([sums[c][0] for c in cells])
        w = train(cells, n, np.array([sums[c][1] for c in cells]) / n)
        accepted = [c for c, z in zip(cells, _design(cells) @ w) if z > 0]
    return {"prior": prior, "reliability": reliability, "posterior": posterior, "accepted": accepted}


def _extract(known: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_kind = pa.list_(pa.struct([(k, pa.int32()) for k in ("kind", "start", "end")]))
        full_kind = pa.list_(pa.struct([(k, pa.int32()) for k in ("kind", "start", "end", "pattern", "cell")]))
        for batch in batches:
            found = [candidates(t.as_py(), known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"),
                 pa.array([[dict(zip(("kind", "start", "end"), s)) for s in b] for b, _ in found], base_kind),
                 pa.array([[dict(zip(("kind", "start", "end", "pattern", "cell"), s)) for s in c] for _, c in found], full_kind)],
                names=["id", "base", "candidates"])

    return run


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None,
              names: frozenset = FIRST_NAMES) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of (kind number, start, end), sorted.

    ``model`` is a fitted model, else one is fitted to ``docs``. ``names`` is the gazetteer of first names. Offsets are code points, end exclusive; kinds
    are numbered as in ``KINDS``. Null text is empty. Repeated rows and null ids keep their rows; an empty table
    gives an empty one; texts are searched whole. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), text_of(docs, text_col).alias("text"))
    found = staged(rows.mapInArrow(_extract(names), (
        f"id {id_type}, base array<struct<kind:int,start:int,end:int>>,"
        " candidates array<struct<kind:int,start:int,end:int,pattern:int,cell:int>>")), "pii-candidates")
    accepted = (model or fit(found))["accepted"]
    own = F.filter("candidates", lambda c: (c.kind >= N_BASE) & c.cell.isin(*accepted, -1))
    fresh = F.transform(own, lambda c: F.struct(c.kind.alias("kind"), c.start.alias("start"), c.end.alias("end")))
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", fresh)).alias("spans"))


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")
