"""URL filters: all glob rules of a list matched at once by a bit-parallel automaton (Shift-And)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapwise.llm.common import ship

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ONE = np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """`name` is reported; `glob` is matched against the canonical URL.

    In a glob, `**` stands for any bytes, `*` for any bytes but `/`, `?` for one
    byte that is not `/`; a backslash takes the next character as it is.
    """

    name: str | None
    glob: str
    verdict: str


def _plain(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with all its subdomains and every path that starts with `path`."""
    return Rule(host + path, f"*.{_plain(host)}{_plain(path)}**", verdict)


#: The listed sites, and words in host names that the method itself blocks.
SITES = (
    site_rule("net", "/", "block"),
    site_rule("example.net", "/en/", "allow"),
    site_rule("example.com", "/de/", "block"),
    site_rule("org", "/fr/", "allow"),
)
HOST_WORDS = ("spam", "casino", "porn")


def word_rules(words: Sequence[str] = HOST_WORDS) -> tuple[Rule, ...]:
    """Block hosts that hold one of the words; such rules have no name of their own."""
    return tuple(Rule(None, f"*{_plain(w)}*{tail}", "block") for w in words for tail in ("", "/**"))


class Automaton:
    """Masks of several machine words, one bit for each state of each rule.

    A rule of m symbols has the states 0 to m. Reading byte c moves a state one
    bit up where the next symbol takes c (`step`), and leaves it standing where a
    star behind it takes c (`stay`). Bit 0 of a rule takes no step, which keeps
    the rules apart.
    """

    def __init__(self, globs: Sequence[str]) -> None:
        symbols = [self._symbols(g) for g in globs]
        states = sum(len(s) + 1 for s, _ in symbols)
        words = max(1, -(-states // 64))
        self.step = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        self.first = np.zeros(words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        slash = np.arange(256) == ord("/")
        bit = 0
        for taken, stars in symbols:
            self.first[bit // 64] |= _ONE << np.uint64(bit % 64)
            for place in range(len(taken) + 1):
                word, mask = bit // 64, _ONE << np.uint64(bit % 64)
                if place:
                    want = taken[place - 1]
                    self.step[~slash if want is None else np.arange(256) == want, word] |= mask
                if stars.get(place):
                    self.stay[~slash if stars[place] == 1 else slice(None), word] |= mask
                bit += 1
            self.final.append(((bit - 1) // 64, _ONE << np.uint64((bit - 1) % 64)))

    @staticmethod
    def _symbols(glob: str) -> tuple[list[int | None], dict[int, int]]:
        """Bytes in order (None: any but a slash), and the stars that stand before each of them."""
        taken: list[int | None] = []
        stars: dict[int, int] = {}
        data, place = glob.encode(), 0
        while place < len(data):
            char = chr(data[place])
            if char == "*":
                both = data[place : place + 2] == b"**"
                stars[len(taken)] = max(stars.get(len(taken), 0), 1 + both)
                place += 1 + both
                continue
            if char == "\\" and place + 1 < len(data):
                place += 1
                taken.append(data[place])
            else:
                taken.append(None if char == "?" else data[place])
            place += 1
        return taken, stars

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """One row for each text, one column for each rule: does the rule take the whole text?"""
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        data = np.frombuffer(b"".join(texts), np.uint8)
        state = np.repeat(self.first[None, :], len(texts), axis=0)
        alive = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        for place, count in enumerate(alive):
            read = data[starts[:count] + place]
            now = state[:count]
            moved = now << _ONE
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:count] = (moved & self.step[read]) | (now & self.stay[read])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        state = state[back]
        out = np.zeros((len(texts), len(self.final)), np.bool_)
        for rule, (word, mask) in enumerate(self.final):
            out[:, rule] = (state[:, word] & mask) != 0
        return out


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = SITES + word_rules(),
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Give each URL its host, path, the rule that decides, and the verdict.

    Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; path:
    on to `?`, `#` or the end. Every rule is matched against `.host/path`. Named rules go before unnamed
    ones, among them the longest name wins, then the order of the list. A URL
    that no rule takes gets `default`. Missing URLs, and those without `://`,
    have empty host and path and are judged like any other. One row for each
    input row; other columns are not kept. An empty table gives an empty table.
    """
    ship(pages.sparkSession)
    ranked = sorted(range(len(rules)), key=lambda i: (rules[i].name is None, -len(rules[i].name or ""), i))
    ordered = [rules[i] for i in ranked]
    globs = [r.glob for r in ordered]
    names = np.array([r.name for r in ordered] + [None], object)
    verdicts = np.array([r.verdict for r in ordered] + [default], object)

    def judged(batches):
        automaton = Automaton(globs)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            hits = automaton.match([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
            best = np.hstack([hits, np.ones((len(hits), 1), np.bool_)]).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(verdicts[best], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("__url"))
    rest = F.expr("CASE WHEN instr(__url, '://') > 0 THEN substring(__url, instr(__url, '://') + 3) END")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    parts = narrow.select(
        "id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")
    )
    kind = narrow.schema["id"].dataType.simpleString()
    return parts.mapInArrow(
        judged, f"page_id {kind}, host string, path string, rule string, verdict string"
    )
