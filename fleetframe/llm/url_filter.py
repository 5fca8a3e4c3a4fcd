"""URL filter: pattern rules indexed by their rarest literal token.

Every rule names literal tokens (runs of a-z and 0-9) that a URL must hold to match. The frequency of
those tokens over all URLs is counted first; a rule is then filed under its rarest one. The tokens of a
URL fetch its candidate rules and only these run their regular expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.llm.common import per_text, read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(UPPER, LOWER)
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class SiteRule:
    """Fits `host` and all its subdomains if the URL's path starts with `path` (which starts with `/`)."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return rf"\A(?:(?!://).)*://(?:[^/?#]*\.)?(?i:{re.escape(self.host)}){re.escape(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Tokens of host and path that are whole in every URL that fits; the last may be cut."""
        text = self.text.translate(_ASCII_LOWER)
        return [m[0] for m in _TOKEN.finditer(text) if m.end() < len(text)]


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs that match `pattern`; every such URL holds all `tokens` as whole tokens."""

    text: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str = "block"


def words_rule(*words: str) -> PatternRule:
    """Blocks hosts that hold the words in this order, joined by `-` or `.`."""
    body = "[-.]".join(re.escape(w) for w in words)
    return PatternRule("-".join(words), rf"(?i)\A(?:(?!://).)*://(?:[^/?#]*[-.])?{body}(?:[-.:][^/?#]*)?(?:[/?#]|\Z)", words)


SITE_RULES = (
    SiteRule("allow", "org", "/"),
    SiteRule("block", "example.org", "/es/"),
    SiteRule("block", "example.org", "/en/1"),
    SiteRule("allow", "com", "/fr/"),
    SiteRule("block", "com", "/de/"),
)
PATTERN_RULES = (
    words_rule("cheap", "pills"), words_rule("free", "bets"), words_rule("adult"), words_rule("casino"),
    words_rule("porn"), words_rule("viagra"), words_rule("payday", "loans"),
)
ALLOWED = "allow"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_frequencies(urls: DataFrame, url: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often the rules' tokens occur in all URLs; at most one row per token of the rules comes back."""
    tokens = F.split(F.translate(F.col(url), UPPER, LOWER), "[^a-z0-9]+")
    rows = (urls.select(F.explode(tokens).alias("token")).where(F.col("token").isin(list(vocabulary)))
            .groupBy("token").count().collect())
    return {row["token"]: row["count"] for row in rows}


def index_rules(rules: Sequence[SiteRule | PatternRule], frequency: dict[str, int]) -> dict[str, list[int]]:
    """Numbers of the rules under their rarest token; under the empty one if a rule has none."""
    index: dict[str, list[int]] = {}
    for number, rule in enumerate(rules):
        rarest = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t), default="")
        index.setdefault(rarest, []).append(number)
    return index


def judge(urls: DataFrame, keep: list[str], url: str = "url",
          site_rules: Sequence[SiteRule] = SITE_RULES, pattern_rules: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """Per row: host, path, rule, verdict and `patterns`, the pattern rules that match.

    The longest site rule that fits decides (of equal ones the first by text). Without one the pattern rules
    decide: block if one matches, else allow. A null URL or one without `://` has empty host and path,
    fits no rule and is allowed. Repeated rows stay repeated.
    """
    rules = [*site_rules, *pattern_rules]
    frequency = token_frequencies(urls, url, sorted({t for rule in rules for t in rule.tokens}))
    index, first_pattern = index_rules(rules, frequency), len(site_rules)
    preference = sorted(range(first_pattern), key=lambda n: (-len(rules[n].text), rules[n].text))
    place = {number: at for at, number in enumerate(preference)}

    def worker(texts: list[str | None]) -> dict[str, list]:
        compiled = [re.compile(rule.pattern, re.ASCII | re.DOTALL) for rule in rules]
        always = index.get("", [])
        fitting, patterns, verdicts = [], [], []
        for text in texts:
            text = text or ""
            tokens = {t for t in _TOKEN.findall(text.translate(_ASCII_LOWER)) if t in index}
            candidates = always + [n for t in tokens for n in index[t]]
            found = [n for n in candidates if compiled[n].search(text)]
            site = min((n for n in found if n < first_pattern), key=place.__getitem__, default=None)
            own = sorted(rules[n].text for n in found if n >= first_pattern)
            fitting.append(None if site is None else rules[site].text)
            patterns.append(own)
            verdicts.append(rules[site].verdict if site is not None else "block" if own else ALLOWED)
        return {"rule": fitting, "verdict": verdicts, "patterns": patterns}

    source = urls.select(*keep, F.col(url).alias("_url"))
    judged = per_text(source.withColumn("_kept", F.col("_url")), [*keep, "_kept"], "_url",
                      "rule string, verdict string, patterns array<string>", worker)
    return judged.select(*keep, host_of(F.col("_kept")).alias("host"), path_of(F.col("_kept")).alias("path"),
                         "rule", "verdict", "patterns")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), ["page_id"]).drop("patterns")


def _sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rules = sorted(SITE_RULES, key=lambda r: (-len(r.text), r.text))
    fits = {r: f"(host = {quoted(r.host)} OR ends_with(host, {quoted('.' + r.host)})) AND starts_with(path, {quoted(r.path)})"
            for r in rules}
    named = " ".join(f"WHEN {fits[r]} THEN {quoted(r.text)}" for r in rules)
    judged = " ".join(f"WHEN {fits[r]} THEN {quoted(r.verdict)}" for r in rules)
    bodies = "|".join("[-.]".join(r.tokens) for r in PATTERN_RULES)
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                 FROM pages),
    parts AS (SELECT page_id,
                     translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                     regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
    SELECT page_id, host, path, CASE {named} END AS rule,
           CASE {judged} WHEN regexp_matches(host, '(^|[-.])({bodies})([-.:]|$)') THEN 'block' ELSE 'allow' END AS verdict
    FROM parts"""


OP2_SQL = _sql()
