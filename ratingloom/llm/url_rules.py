"""URL rules as one bit-parallel wildcard automaton.

All patterns are packed into multiword Shift-And masks: a pattern of m characters takes m + 1 bits, the first of them
its start. One step per URL character moves every pattern at once, and a batch of URLs takes each step together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import text_frame

#: Between host and path of a canonical URL; neither can hold it.
MARK = "#"
STEP_CELLS = 1 << 18  # URLs taken together, times mask words


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        literal = lambda s: s.replace("\\", "\\\\").replace("*", "\\*").replace("?", "\\?")
        return f"*.{literal(self.host)}{MARK}{literal(self.path)}*"


#: The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: Globs over `.host#path` that block a URL without a rule; all else is allowed.
BLOCK_GLOBS = ("*.spam-*#*", "*.casino-*#*", "*#*/cgi-bin/*", "*#*.exe")


def _parsed(glob: str) -> tuple[list[int | None], list[int]]:
    """Bytes to match in order (None: any byte) and the places followed by a star."""
    chars: list[int | None] = []
    stars: list[int] = []
    raw, i = glob.encode(), 0
    while i < len(raw):
        c = raw[i : i + 1]
        if c == b"*":
            stars.append(len(chars))
        elif c == b"?":
            chars.append(None)
        else:
            if c == b"\\" and i + 1 < len(raw):
                i += 1
            chars.append(raw[i])
        i += 1
    return chars, stars


class Automaton:
    """All globs at once. `*` stands for any bytes, `?` for one byte, a backslash takes the next byte as it is."""

    def __init__(self, globs: Sequence[str]):
        parsed = [_parsed(g) for g in globs]
        size = sum(len(chars) + 1 for chars, _ in parsed)
        self.words = max(1, -(-size // 64))
        self.step = np.zeros((256, self.words), np.uint64)  # places a byte may lead to
        self.stay = np.zeros(self.words, np.uint64)  # places followed by a star
        self.start = np.zeros(self.words, np.uint64)
        self.last: list[tuple[int, np.uint64]] = []
        at = 0
        for chars, stars in parsed:
            self._set(self.start, at)
            for s in stars:
                self._set(self.stay, at + s)
            for i, c in enumerate(chars, 1):
                for byte in range(256) if c is None else [c]:
                    self._set(self.step[byte], at + i)
            at += len(chars)
            self.last.append((at // 64, np.uint64(1) << np.uint64(at % 64)))
            at += 1

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Boolean matrix: texts x globs, true where the glob fits the whole text."""
        sizes = np.diff(offsets)
        out = np.zeros((len(sizes), len(self.last)), bool)
        order = np.argsort(-sizes, kind="stable")  # the longest first: those still running are a prefix
        block = max(1, STEP_CELLS // self.words)
        for lo in range(0, len(order), block):
            rows = order[lo : lo + block]
            at, left = offsets[rows], sizes[rows]
            state = np.repeat(self.start[None, :], len(rows), axis=0)
            live = len(rows)
            for i in range(int(left[0]) if len(left) else 0):
                live = int(np.searchsorted(-left[:live], -i, "left"))
                now = state[:live]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                state[:live] = (moved & self.step[data[at[:live] + i]]) | (now & self.stay)
            for j, (word, bit) in enumerate(self.last):
                out[rows, j] = (state[:, word] & bit) != 0
        return out


def canonical(url):
    """(host, path) columns: the host after the first `://` up to `/`, `?`, `#` or the end with A-Z lower-cased, the path from there up to `?`, `#` or the end; both empty without a `://`."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, block_globs: Sequence[str] = BLOCK_GLOBS) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    The fitting rule with the longest host and path wins (ties: the longer host, then the earlier text). Without a
    rule a URL is blocked where one of ``block_globs`` fits, else allowed. A null URL, or one without `://`, has an
    empty host and path, fits no rule and is allowed. Repeated rows and null ids come back as they are; other columns
    are ignored. The rules must fit one mask table per task; no row is shuffled.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    names = np.array([r.text for r in ranked] + [None], object)
    verdicts = np.array([r.verdict for r in ranked], object)
    globs = [r.glob for r in ranked] + list(block_globs)
    schema = "page_id long, host string, path string, rule string, verdict string"

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for batch in batches:
            for lo, hi, data, offsets in tp.slices(batch.column(3)):
                fits = automaton.run(data, offsets)
                by_rule, by_glob = fits[:, : len(ranked)], fits[:, len(ranked) :].any(axis=1)
                best = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1) if len(ranked) else 0, len(ranked))
                verdict = np.where(by_glob, "block", "allow").astype(object)
                told = best < len(ranked)
                verdict[told] = verdicts[best[told]]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, hi - lo) for i in range(3)], pa.array(names[best], pa.string()), pa.array(verdict, pa.string())], schema=tp.arrow_schema(schema)
                )

    host, path = canonical(F.col("url").cast("string"))
    rows = text_frame(pages).select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return rows.select("*", F.concat(F.lit("."), "host", F.lit(MARK), "path").alias("whole")).mapInArrow(decide, schema)
