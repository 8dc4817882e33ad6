"""URL filters: all glob rules packed into multiword Shift-And masks and run over each canonical URL at once.

The canonical form is ``host#path``: `#` occurs in neither part, so a star never leaves the part it stands
for. A rule (host, path) becomes two globs, ``host#path*`` and ``*.host#path*``; the free globs decide where no rule fits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

#: verdict, host, path prefix
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: globs over host#path that block a URL no rule fits
BLOCKED_GLOBS = ("*casino*#*", "*free-bets*#*", "*cheap-pills*#*", "*#*/login*", "*#*.exe")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class GlobAutomaton:
    """Shift-And masks of globs over UTF-8 bytes: `*` any bytes, `?` one byte, `\\` takes the next byte as it is.

    Bit i of a pattern says that its first i symbols are read. A star keeps the bit before it alive on any byte.
    """

    def __init__(self, globs: Sequence[str]):
        bits = 0
        start, final, loops, symbols = [], [], [], []
        for glob in globs:
            start.append(bits)
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i] == 42:
                    loops.append(bits)
                else:
                    literal = raw[i] == 92 and i + 1 < len(raw)
                    i += literal
                    bits += 1
                    symbols.append((bits, None if raw[i] == 63 and not literal else raw[i]))
                i += 1
            final.append(bits)
            bits += 1
        self.words = -(-max(bits, 1) // 64)
        self.start, self.loops = self._pack(start), self._pack(loops)
        self.final = np.array(final, np.int64)
        self.masks = np.zeros((256, self.words), np.uint64)
        for bit, byte in symbols:
            rows = slice(None) if byte is None else byte
            self.masks[rows, bit // 64] |= np.uint64(1 << (bit % 64))

    def _pack(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for bit in bits:
            out[bit // 64] |= np.uint64(1 << (bit % 64))
        return out

    def match(self, chunk: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each row and glob, whether the glob matches the whole row."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = offsets[:-1][order], lengths[order]
        state = np.tile(self.start, (len(order), 1))
        one, top = np.uint64(1), np.uint64(63)
        live = len(order)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            while live and lengths[live - 1] <= step:
                live -= 1
            old = state[:live]
            moved = old << one
            moved[:, 1:] |= old[:, :-1] >> top
            moved &= self.masks[chunk[begin[:live] + step]]
            moved |= old & self.loops
            state[:live] = moved
        found = (state[:, self.final // 64] >> (self.final % 64).astype(np.uint64)) & one
        out = np.empty((len(order), len(self.final)), bool)
        out[order] = found.astype(bool)
        return out


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def url_verdicts(pages: DataFrame, rules=RULES, blocked_globs: Sequence[str] = BLOCKED_GLOBS) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    The host is what stands between the first `://` and the next `/`, `?`, `#` or end, A-Z lowered; the path goes on
    to `?`, `#` or end. A null url, or one without `://`, has both empty. A rule fits its host and all subdomains
    where the path starts with the rule's; the longest host and path wins, of equally long ones the first.
    Without a fitting rule, `rule` is null and the free globs decide. Other columns of the pages are not read; repeated rows
    are judged one by one; an empty table gives no rows.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    names = [host + path for _, host, path in ranked]
    verdicts = [verdict for verdict, _, _ in ranked]
    globs = [g for _, host, path in ranked for g in (f"{_literal(host)}#{_literal(path)}*", f"*.{_literal(host)}#{_literal(path)}*")]
    n_rules = len(ranked)
    automaton = GlobAutomaton([*globs, *blocked_globs])

    @F.pandas_udf("rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        import pyarrow as pa

        rule_of, verdict_of = [], []
        for _, _, chunk, offsets in text_chunks(pa.array(urls, pa.string())):
            hits = automaton.match(chunk, offsets)
            by_rule = hits[:, :2 * n_rules].reshape(len(hits), n_rules, 2).any(axis=2)
            blocked = hits[:, 2 * n_rules:].any(axis=1)
            fits = by_rule.any(axis=1)
            for has, k, bad in zip(fits, by_rule.argmax(axis=1) if n_rules else fits, blocked):
                rule_of.append(names[k] if has else None)
                verdict_of.append(verdicts[k] if has else "block" if bad else "allow")
        return pd.DataFrame({"rule": rule_of, "verdict": verdict_of}, dtype=object)

    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parts = pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )
    judged = parts.withColumn("judged", judge(F.concat("host", F.lit("#"), "path")))
    return judged.select("page_id", "host", "path", "judged.rule", "judged.verdict")


def oracle_sql(rules=RULES, blocked_globs: Sequence[str] = BLOCKED_GLOBS) -> str:
    """The same rows for DuckDB; free globs may use `*` alone."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ranked]
    free = " OR ".join(f"host || '#' || path GLOB '{g}'" for g in blocked_globs)
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ranked))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ranked))
    return f"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        )
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {verdict} WHEN {free} THEN 'block' ELSE 'allow' END AS verdict
        FROM parts
    """
