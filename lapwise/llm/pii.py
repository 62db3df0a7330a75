"""Personal data: regular expressions propose, checksums confirm, nearby words adjust a score. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Kind:
    """`pattern` proposes; a match for which `valid` (SQL over `m`) fails is dropped.

    `sign` is a cheap test of the whole text that every match implies. `prior` is
    the score of a valid match, `context` the words that raise it by `lift` when
    one stands in the `NEAR` code points before the match, back to the last match. Spans of a kind that is
    not `base` need a score of `LEAST`.
    """

    name: str
    pattern: str
    valid: str
    sign: str
    prior: float
    context: str
    base: bool = True
    lift: float = 0.3


#: Code points before a match in which context counts, and the least score of a span that is not base.
NEAR, LEAST = 40, 0.6

_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_LUHN = """
    pmod(aggregate(transform(sequence(1, length({d})), i -> (length({d}) - i) % 2 * 10 + cast(substring({d}, i, 1) AS int)),
        0, (total, v) -> total + CASE WHEN v < 10 THEN v WHEN v < 15 THEN 2 * (v - 10) ELSE 2 * (v - 10) - 9 END), 10) = 0
""".format(d=_DIGITS)
_IBAN = "regexp_replace(m, ' ', '')"
_MOD_97 = """
    aggregate(split(concat(substring({c}, 5), substring({c}, 1, 4)), ''), 0, (rest, c) ->
        CASE WHEN c = '' THEN rest
             WHEN c < 'A' THEN (rest * 10 + cast(c AS int)) % 97
             ELSE (rest * 100 + ascii(c) - 55) % 97 END) = 1
""".format(c=_IBAN)

# Possessive runs take what the greedy ones would, without a stack frame for each character. A match that
# cannot start at the head of a run cannot start later in it, so starts are held to heads and ends of matches.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", "instr(text, '@') > 0", 0.9, "mail|write|contact"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         "forall(split(m, '[.]'), p -> coalesce(try_cast(p AS int) <= 255, false))",
         "text RLIKE '[0-9][.][0-9]'", 0.7, "ip|server|host|address|login"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++",
         f"CASE WHEN length({_DIGITS}) BETWEEN 13 AND 19 THEN {_LUHN} ELSE false END",
         "text RLIKE '[0-9][ -]?[0-9]'", 0.7, "card|visa|credit|pay|account"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15",
         "instr(text, '+') > 0", 0.7, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         f"length({_IBAN}) BETWEEN 15 AND 34 AND {_MOD_97}", "text RLIKE '[A-Z]{2}[0-9]{2}'", 0.8,
         "iban|bank|account|transfer", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         "substring(m, 1, 3) NOT IN ('000', '666') AND substring(m, 1, 1) <> '9'"
         " AND substring(m, 5, 2) <> '00' AND substring(m, 8, 4) <> '0000'",
         "text RLIKE '[0-9]-[0-9]'", 0.4, "ssn|social|security", base=False),
)
_SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(kind: Kind) -> str:
    """SQL for the spans of one kind in `text`.

    The text between matches (field 0 of `z`) and the matches (field 1) alternate, so their lengths add up
    to positions, in code points.
    """
    pattern = _quoted(kind.pattern)
    near = f"substring(z.`0`, -{NEAR})"
    context = _quoted(rf"(?i)(?<![a-z])(?:{kind.context})")
    score = f"{kind.prior}D + CASE WHEN {near} RLIKE {context} THEN {kind.lift}D ELSE 0D END"
    valid = kind.valid.replace("(m,", "(z.`1`,").replace("(m)", "(z.`1`)")
    wanted = f"({valid})" if kind.base else f"({valid}) AND {score} >= {LEAST}D"
    span = (
        f"named_struct('kind', '{kind.name}', 'start', a.at + length(z.`0`), "
        f"'end', a.at + length(z.`0`) + length(z.`1`), 'score', least(1D, {score}))"
    )
    return f"""
        CASE WHEN {kind.sign} THEN aggregate(
            arrays_zip(split(text, {pattern}, -1), regexp_extract_all(text, {pattern}, 0)),
            named_struct('at', 0, 'out', cast(array() AS {_SPANS})),
            (a, z) -> named_struct(
                'at', a.at + length(z.`0`) + coalesce(length(z.`1`), 0),
                'out', CASE WHEN z.`1` IS NOT NULL AND {wanted} THEN concat(a.out, array({span})) ELSE a.out END),
            a -> a.out)
        ELSE cast(array() AS {_SPANS}) END
    """


def find_pii(docs: DataFrame, kinds: Sequence[Kind] = KINDS, text_col: str = "text", into: str = "spans") -> DataFrame:
    """Add `into`: the spans of personal data as (kind, start, end, score), by kind in the given order, then start.

    Positions are code points, ends exclusive. Within a kind matches are leftmost
    and do not overlap, and a match that fails its check is dropped without
    another try; spans of different kinds may overlap. A missing or empty text has
    no spans. All columns are kept, so rows, repeated ones too, stay as they are.
    """
    inside = "concat(" + ", ".join(_spans(k) for k in kinds) + ")"
    held = docs.withColumn("__held", F.struct(*docs.columns)).select(
        "__held", F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return held.withColumn("__spans", F.expr(inside)).select("__held.*", F.col("__spans").alias(into))


def masked(docs: DataFrame, spans: str = "spans", text_col: str = "text") -> DataFrame:
    """Replace each span of `text_col` by its kind in brackets, and drop `spans`.

    A span that overlaps an earlier one is blotted out with it. A missing text stays missing.
    """
    pieces = """
        aggregate(
            array_sort(__spans, (x, y) -> CASE WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1
                                               WHEN x.end > y.end THEN -1 WHEN x.end < y.end THEN 1 ELSE 0 END),
            named_struct('at', 0, 'out', cast(array() AS array<string>)),
            (a, s) -> named_struct(
                'at', greatest(a.at, s.end),
                'out', CASE WHEN s.start < a.at THEN a.out
                       ELSE concat(a.out, array(substring(text, a.at + 1, s.start - a.at), concat('[', upper(s.kind), ']'))) END),
            a -> concat(array_join(a.out, ''), substring(text, a.at + 1)))
    """
    held = docs.select(
        F.struct(*[c for c in docs.columns if c != spans]).alias("__held"),
        F.col(text_col).alias("text"), F.col(spans).alias("__spans"),
    )
    clean = F.when(F.size("__spans") > 0, F.expr(pieces)).otherwise(F.col("text"))
    return held.select(F.col("__held").withField(text_col, clean).alias("__held")).select("__held.*")


def listed(spans: str, kinds: Sequence[str] | None = None) -> Column:
    """`kind:start:end` of the spans, comma-joined in their order."""
    chosen = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
