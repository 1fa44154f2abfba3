"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of one pattern per kind. Labelers vote on each: the check of its kind
(digit sums, ranges, digit counts), gazetteers (endings, calling codes, issuers, countries), the
words before it, its edges, and the variety of its characters. How reliable each labeler is, and
what share of each kind is real, is estimated by expectation-maximisation over the vote patterns
of the whole corpus. A logistic span classifier is then trained on the estimated labels, and it
decides which further spans are added. Matches of the four base kinds that pass their check always
stay; a match that fails the check of its kind is never added.

Everything that touches rows is built from SQL functions: a match's place is the running sum of the
lengths of what lies between and inside the matches, in code points. Vote patterns are counted by
Spark; there are at most PATTERNS of them whatever the input, so the estimation needs no rows.

Patterns run in time linear in the text: possessive quantifiers, and a match may only begin where a
run of its characters begins or the match before ended, which are the only places it can.

Cases: null and empty texts have no spans; a corpus without candidates trains nothing and adds
nothing; repeated rows give repeated results; spans of different base kinds may overlap; an added
span never overlaps a base span or one added before; other input columns are left out (`spans`) or
kept (`redacted`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.session import durable


@dataclass(frozen=True)
class Kind:
    """`pattern` finds candidates, `guard` says cheaply whether a text can hold any; `check` and
    `listed` are SQL over the match `h`, `near` a pattern for the words before it."""

    name: str
    pattern: str
    guard: str
    check: str
    listed: str
    near: str
    base: bool = False


_DIGITS = "regexp_replace(h, '[^0-9]', '')"
_LUHN = (
    f"aggregate(transform(sequence(1, length({_DIGITS})), k -> cast(substr({_DIGITS}, length({_DIGITS}) - k + 1, 1) AS int)"
    " * IF(k % 2 = 0, 2, 1)), 0, (s, x) -> s + IF(x > 9, x - 9, x)) % 10 = 0"
)
#: Endings, calling codes and countries that labelers know.
_ENDINGS = "com|org|net|edu|gov|int|info|io|de|fr|es|uk|eu|at|ch|it|nl|be|pl|pt|se|us|ca|au|jp|cn|in|br|mx"
_CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE"
_MAIL = "[A-Za-z0-9._%+-]"

KINDS = (
    Kind(
        "email", rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')",
        "true", rf"lower(h) RLIKE '\\.({_ENDINGS})$'", "mail|contact|write|kontakt|correo|courriel", base=True,
    ),
    Kind(
        "ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"_digit AND text RLIKE '[0-9]\\.[0-9]++\\.[0-9]'",
        r"forall(split(h, '\\.'), p -> length(ltrim('0', p)) < 4 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)",
        r"NOT h RLIKE '^(0|22[4-9]|23|24|25[0-5])\\.'", r"\bip\b|address|server|host|adresse", base=True,
    ),
    Kind(
        "card", r"[0-9](?:[ -]?+[0-9])++", "_digit AND text RLIKE '(?:[0-9][ -]?+){12}[0-9]'",
        f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}", f"{_DIGITS} RLIKE '^(3[47]|4|5[1-5]|2[2-7]|6)'",
        "card|visa|credit|karte|carte|tarjeta|payment", base=True,
    ),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", "_digit AND contains(text, '+')", f"length({_DIGITS}) BETWEEN 9 AND 15",
        rf"{_DIGITS} RLIKE '^({_CALLING})'", r"phone|call|\btel|fax|mobil|handy", base=True,
    ),
    Kind(
        "spelled_email", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}+ ?[\[(][aA][tT][\])] ?[A-Za-z0-9-]{2,64}(?: ?[\[(][dD][oO][tT][\])] ?|\.)[A-Za-z]{2,24}",
        r"text RLIKE '[\\[(][aA][tT][\\])]'", "true", rf"lower(h) RLIKE '({_ENDINGS})$'", "mail|contact|write|kontakt|correo|courriel",
    ),
    Kind(
        "national_phone", r"(?<![0-9+.()-])(?:\([0-9]{2,5}+\)|[0-9]{3,5}+)[ .-][0-9]{3,4}+[ .-][0-9]{4}+(?![0-9])",
        "_digit AND text RLIKE '[0-9][ )].?[0-9]{3}|[0-9][.-][0-9]{3}'", f"length({_DIGITS}) BETWEEN 9 AND 13",
        f"{_DIGITS} RLIKE '^(0[1-9]|[2-9])'", r"phone|call|\btel|fax|mobil|handy",
    ),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "_digit AND text RLIKE '[A-Z]{2}[0-9]{2}'",
        # Letters count as 10 to 35; the remainder of the whole number is taken digit by digit.
        "aggregate(split(concat(substr(replace(h, ' ', ''), 5), substr(h, 1, 4)), ''), 0, (s, c) -> IF(c = '', s,"
        " IF(c BETWEEN '0' AND '9', (s * 10 + ascii(c) - 48) % 97, (s * 100 + ascii(c) - 55) % 97))) = 1",
        f"h RLIKE '^({_COUNTRIES})'", r"iban|bank|account|konto|compte|cuenta",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "_digit AND text RLIKE '[0-9]-[0-9]{2}-[0-9]'",
        "NOT h RLIKE '^(000|666|9)|-00-|-0000$'", "false", r"ssn|social|security",
    ),
)
BASE = tuple(k.name for k in KINDS if k.base)

#: Words that speak against personal data.
_AGAINST = r"version|order|invoice|isbn|issn|figure|table|total|price|page|chapter|seed|checksum|build"
_BEFORE = 40

#: Votes: 1 for, 0 against, 2 abstains. All labelers and features with the values they can take.
VOTES = {"v_check": 2, "v_listed": 2, "v_words": 3, "v_edges": 2, "v_variety": 3}
FEATURES = {**VOTES, "f_long": 2, "f_line": 2}
PATTERNS = len(KINDS) * math.prod(FEATURES.values())


def _running(steps: str, at: str) -> str:
    """Sum of the entries 0 to `at` of an array column. Sums of runs of 64 keep long arrays cheap."""
    add = "CAST(0 AS bigint), (s, x) -> s + x"
    return (
        f"(aggregate(slice({steps}_runs, 1, CAST({at} DIV 64 AS int)), {add})"
        f" + aggregate(slice({steps}, CAST({at} - {at} % 64 + 1 AS int), CAST({at} % 64 + 1 AS int)), {add}))"
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def candidates(docs: DataFrame, text: Column) -> DataFrame:
    """The rows with `text` (never null) and `found`: for each candidate its kind, place, base flag, votes
    and features, in the order of KINDS and then of places."""
    rows = docs.withColumn("text", F.coalesce(text, F.lit("")))
    rows = rows.withColumn("_digit", F.expr("text RLIKE '[0-9]'"))
    for kind in KINDS:
        h, s, pattern = f"_h_{kind.name}", f"_s_{kind.name}", _quoted(kind.pattern)
        rows = rows.withColumn(h, F.expr(f"IF({kind.guard}, regexp_extract_all(text, {pattern}, 0), array())"))
        gaps = F.expr(f"IF(size({h}) > 0, transform(split(text, {pattern}, -1), x -> CAST(length(x) AS bigint)), array())")
        rows = rows.withColumn(f"_g_{kind.name}", gaps)
        rows = rows.withColumn(
            s, F.expr(f"transform({h}, (x, i) -> _g_{kind.name}[i] + IF(i > 0, CAST(length({h}[i - 1]) AS bigint), 0L))")
        )
        runs = (
            f"transform(filter({s}, (x, i) -> i % 64 = 0), (x, i) ->"
            f" aggregate(slice({s}, i * 64 + 1, 64), CAST(0 AS bigint), (a, b) -> a + b))"
        )
        rows = rows.withColumn(f"{s}_runs", F.expr(runs))
        placed = f"transform({h}, (h, i) -> named_struct('h', h, 'start', {_running(s, 'i')}))"
        rows = rows.withColumn(f"_p_{kind.name}", F.expr(placed))
        rows = rows.withColumn(
            f"_c_{kind.name}",
            F.expr(
                f"transform(_p_{kind.name}, p -> named_struct('h', p.h, 'start', p.start, 'end', p.start + length(p.h),"
                f" 'before', lower(substring(text, CAST(greatest(p.start - {_BEFORE}, 0) + 1 AS int), CAST(least(p.start, {_BEFORE}) AS int))),"
                " 'edge', concat(IF(p.start > 0, substring(text, CAST(p.start AS int), 1), ' '), '|',"
                " substring(text, CAST(p.start + length(p.h) + 1 AS int), 1))))"
            ),
        )
        rows = rows.withColumn(f"_c_{kind.name}", F.expr(f"transform(_c_{kind.name}, p -> {_voted(kind)})"))
        rows = rows.drop(h, f"_g_{kind.name}", s, f"{s}_runs", f"_p_{kind.name}")
    found = F.concat(*[F.col(f"_c_{k.name}") for k in KINDS])
    return rows.withColumn("found", found).drop("_digit", *[f"_c_{k.name}" for k in KINDS])


def _voted(kind: Kind) -> str:
    check, listed = (c.replace("(h", "(p.h").replace("h RLIKE", "p.h RLIKE") for c in (kind.check, kind.listed))
    against, near = _quoted(_AGAINST), _quoted(kind.near)
    votes = {
        "v_check": f"IF({check}, 1, 0)",
        "v_listed": f"IF({listed}, 1, 0)",
        "v_words": f"CASE WHEN p.before RLIKE {near} THEN 1 WHEN p.before RLIKE {against} THEN 0 ELSE 2 END",
        "v_edges": r"IF(p.edge RLIKE '^[\\s(<\\[\"\':;,]\\|([\\s.,;:!?)>\\]\"\']|$)', 1, 0)",
        "v_variety": "IF(size(array_distinct(split(p.h, ''))) < 5, 0, 2)",
    }
    features = {
        "f_long": "IF(length(p.h) > 14, 1, 0)",
        "f_line": r"IF(p.before = '' OR p.before RLIKE '\\n$', 1, 0)",
    }
    fields = ", ".join(f"'{k}', {v}" for k, v in (votes | features).items())
    return (
        f"named_struct('kind', '{kind.name}', 'start', p.start, 'end', p.end,"
        f" 'base', {str(kind.base).lower()} AND ({check}), {fields})"
    )


@dataclass
class Model:
    """Reliabilities of the labelers (share of each vote among false and real spans), the share of
    real spans by kind, and the weights of the span classifier by feature value."""

    votes: dict[str, np.ndarray]
    real: dict[str, float]
    weights: dict[tuple[str, object], float]
    intercept: float

    def probability(self, c: str) -> str:
        """SQL for the classifier's probability of the candidate struct `c`."""
        terms = [f"{self.intercept:.9f}D"]
        for name in ("kind", *FEATURES):
            own = {v: w for (n, v), w in self.weights.items() if n == name}
            if own:
                cases = " ".join(f"WHEN {repr(v) if isinstance(v, str) else v} THEN {w:.9f}D" for v, w in sorted(own.items()))
                terms.append(f"CASE {c}.{name} {cases} ELSE 0D END")
        return f"(1 / (1 + exp(-({' + '.join(terms)}))))"


def patterns(rows: DataFrame) -> list[tuple[dict, int]]:
    """Vote patterns of all candidates with their numbers; at most PATTERNS."""
    flat = rows.select(F.explode("found").alias("c")).select("c.kind", *[f"c.{f}" for f in FEATURES])
    return [(r.asDict(), r["n"]) for r in flat.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).collect()]


def estimate(counted: list[tuple[dict, int]], rounds: int = 50) -> tuple[dict[str, np.ndarray], dict[str, float], np.ndarray]:
    """Expectation-maximisation: labeler reliabilities, shares of real spans, and each pattern's posterior.

    Labelers start as right in four of five votes, the share of real spans at a half; one count is
    added everywhere, so a kind or vote that is rare keeps close to the start.
    """
    n = np.array([c for _, c in counted], dtype=float)
    theta = {
        name: np.array([[0.8, 0.2], [0.2, 0.8]]) if size == 2 else np.array([[0.4, 0.1, 0.5], [0.1, 0.4, 0.5]])
        for name, size in VOTES.items()
    }
    kinds = sorted({p["kind"] for p, _ in counted})
    real = dict.fromkeys(kinds, 0.5)
    posterior = np.full(len(counted), 0.5)
    for _ in range(rounds):
        for i, (p, _) in enumerate(counted):
            odds = math.log(real[p["kind"]] / (1 - real[p["kind"]]))
            odds += sum(math.log(theta[v][1][p[v]] / theta[v][0][p[v]]) for v in VOTES)
            posterior[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for kind in kinds:
            own = np.array([p["kind"] == kind for p, _ in counted])
            real[kind] = float(((n * posterior)[own].sum() + 1) / (n[own].sum() + 2))
        for name, size in VOTES.items():
            value = np.array([p[name] for p, _ in counted])
            for y, weight in ((0, n * (1 - posterior)), (1, n * posterior)):
                counts = np.array([weight[value == v].sum() for v in range(size)]) + 1
                theta[name][y] = counts / counts.sum()
    return theta, real, posterior


def train(counted: list[tuple[dict, int]], posterior: np.ndarray, ridge: float = 1.0) -> tuple[dict, float]:
    """Logistic regression on the features of the patterns, weighted by their numbers and posteriors."""
    names = sorted({(f, p[f]) for p, _ in counted for f in ("kind", *FEATURES)}, key=str)
    x = np.array([[1.0, *[float(p[f] == v) for f, v in names]] for p, _ in counted])
    n = np.array([c for _, c in counted], dtype=float)
    beta, keep = np.zeros(x.shape[1]), ridge * np.diag([0.01] + [1.0] * len(names))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + keep, x.T @ (n * (posterior - p)) - keep @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return {name: float(b) for name, b in zip(names, beta[1:])}, float(beta[0])


def fit(rows: DataFrame) -> Model:
    """Estimate the labelers and train the classifier on the candidates of all rows."""
    counted = sorted(patterns(rows), key=lambda x: str(sorted(x[0].items())))
    if not counted:
        return Model({}, {}, {}, -30.0)
    theta, real, posterior = estimate(counted)
    weights, intercept = train(counted, posterior)
    return Model(theta, real, weights, intercept)


def kept(rows: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows with `spans`: base spans, then the added ones."""
    accepted = f"NOT c.base AND c.v_check = 1 AND NOT ({' OR '.join(repr(b) + ' = c.kind' for b in BASE)}) AND {model.probability('c')} >= {threshold}"
    rows = rows.withColumn("_base", F.expr("filter(found, c -> c.base)"))
    rows = rows.withColumn("_more", F.expr(f"filter(found, c -> {accepted})"))
    rows = rows.withColumn("_more", F.expr("filter(_more, c -> NOT exists(_base, b -> b.start < c.end AND c.start < b.end))"))
    # Of added spans that overlap, the first by kind and place stays; one that goes stands in no other's way.
    rows = rows.withColumn("_more", F.expr(
        "aggregate(_more, filter(_more, c -> false), (held, c) -> IF(exists(held, b -> b.start < c.end AND c.start < b.end), held, concat(held, array(c))))"
    ))
    return rows.withColumn("spans", F.concat("_base", "_more")).drop("_base", "_more", "found")


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans): counts and spans of the base kinds, and all
    spans, as `kind:start:end` lists by kind and place. One pass over the texts."""
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    rows = durable(candidates(named, F.col("text")).drop("text"), "candidates")
    rows = kept(rows, fit(rows))
    rows = rows.withColumn("_b", F.expr(f"filter(spans, s -> s.kind IN ({', '.join(map(repr, BASE))}))"))
    counts = [F.expr(f"CAST(size(filter(_b, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE]
    return rows.select(
        F.col("_key").alias(key), *counts, F.expr(_joined("_b")).alias("base"), F.expr(_joined("spans")).alias("spans")
    )


def redacted(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The input rows with each span replaced by its kind in angle brackets, all columns kept.
    A column `length` with the texts' lengths follows the new texts."""
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("_row"), F.col(text).alias("text"))
    model = fit(durable(candidates(packed.select("text"), F.col("text")).select("found"), "candidates"))
    rows = kept(candidates(packed, F.col("text")), model)
    # Overlapping spans become one, named after the first.
    rows = rows.withColumn("spans", F.expr("array_sort(transform(spans, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"))
    cut = (
        "aggregate(spans, named_struct('at', CAST(0 AS bigint), 'out', ''), (a, s) -> IF(s.start >= a.at,"
        " named_struct('at', s.end, 'out', concat(a.out, substring(text, CAST(a.at + 1 AS int), CAST(s.start - a.at AS int)), '<', upper(s.kind), '>')),"
        " named_struct('at', greatest(a.at, s.end), 'out', a.out)),"
        " a -> concat(a.out, substring(text, CAST(a.at + 1 AS int))))"
    )
    rows = rows.withColumn("_new", F.expr(f"IF(size(spans) > 0, {cut}, _row.`{text}`)"))
    out = []
    for name in names:
        column = F.col("_row")[name]
        if name == text:
            column = F.col("_new")
        elif name == length:
            column = F.when(F.size("spans") > 0, F.length("_new").cast(docs.schema[name].dataType)).otherwise(column)
        out.append(column.alias(name))
    return rows.select(*out)
