"""URL filtering by pattern rules that are indexed by their rarest literal token."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules travel to every executor; more characters of rules than this are refused.
RULE_CHARS = 64_000_000
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """verdict for urls that the pattern fits. Of several, the greatest rank wins, then the longest name, then the name.

    A pattern is matched against `host` + `path` of a url, in lower case for the
    host: `||a.b/c` fits host a.b and its subdomains where the path starts with /c;
    any other pattern fits anywhere; `*` stands for any characters, `^` for a separator or the end.
    """

    name: str
    verdict: str
    pattern: str
    rank: int = 0


def host_rule(verdict: str, rule: str) -> Rule:
    """A (host, path) rule written as host/path. These outrank plain patterns."""
    return Rule(rule, verdict, "||" + rule, 1)


#: What the query op7 is asked to judge by.
HOST_RULES = (host_rule("block", "net/"), host_rule("allow", "example.net/en/"), host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/"))
#: The method's own rules, for urls that none of the above fits.
PATTERN_RULES = tuple(
    Rule(p, "block", p) for p in ("||doubleclick.net^", "||adserver.*^", "/adserver/", "/banner-ads/", "/popunder/", "/tracking-pixel.", "/phishing/", "/malware/", "/casino-bonus/", "/xxx-videos/")
)


def compiled(pattern: str) -> re.Pattern:
    anchored = pattern.startswith("||")
    body = "".join({"*": ".*", "^": r"(?:[^\w.%-]|$)"}.get(c) or re.escape(c) for c in pattern.removeprefix("||"))
    return re.compile((r"(?:[^/]*\.)?" if anchored else r".*?") + body, re.DOTALL)


def literal_tokens(pattern: str) -> list[str]:
    """Runs of letters and digits that a matching url must hold as whole tokens: bounded on both sides by the pattern itself."""
    body, out = pattern.removeprefix("||").lower(), []
    for m in _TOKEN.finditer(body):
        before = body[m.start() - 1] if m.start() else ("." if pattern.startswith("||") else "")
        after = body[m.end()] if m.end() < len(body) else ""
        if before and before not in "*" and after and after not in "*":
            out.append(m.group())
    return out


def build_index(rules: tuple[Rule, ...]) -> tuple[dict[str, list], list]:
    """token -> its rules, and the rules without a literal token, which every url runs. Each rule stands under its rarest token."""
    tokens = {r: literal_tokens(r.pattern) for r in rules}
    seen = Counter(t for own in tokens.values() for t in {*own})
    index, rest = defaultdict(list), []
    for r in rules:
        entry = (compiled(r.pattern), (r.rank, len(r.name), r.name), r.verdict)
        if own := tokens[r]:
            index[min(own, key=lambda t: (seen[t], -len(t), t))].append(entry)
        else:
            rest.append(entry)
    return dict(index), rest


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first :// up to / ? # or end, A-Z in lower case; path then up to ? # or end."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    return m[1].translate(_LOWER), m[2]


_LOWER = {c: c + 32 for c in range(65, 91)}


def judge_urls(df: DataFrame, rules: tuple[Rule, ...] = HOST_RULES + PATTERN_RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow", named: tuple[Rule, ...] | None = None) -> DataFrame:
    """Verdict of each row's url: page_id, host, path, rule, verdict, in one pass without a shuffle.

    A url's tokens fetch candidate rules from the index and only those run their
    regular expression. rule names the winner if it is among `named` (default:
    all); without a winner the verdict is `default` and rule is null. A null url or one without `://`
    has empty host and path and fits no rule. Repeated rows are judged each; other columns are not read.
    """
    if sum(len(r.pattern) for r in rules) > RULE_CHARS:
        raise ValueError("too many rules to send to every executor")
    public = {r.name for r in (rules if named is None else named)}

    def run(batches):
        import pyarrow as pa

        index, rest = build_index(rules)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                whole = host + path
                found = [e for t in {*_TOKEN.findall(whole.lower())} for e in index.get(t, ()) if e[0].match(whole)] if whole else []
                found += [e for e in rest if whole and e[0].match(whole)]
                best = max(found, key=lambda e: e[1], default=None)
                out.append((host, path, best[1][2] if best and best[1][2] in public else None, best[2] if best else default))
            columns = [pa.array(c, pa.string()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.string())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["page_id", "host", "path", "rule", "verdict"])

    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
