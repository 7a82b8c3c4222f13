"""URL filters: allow and block rules first, host reputation by empirical Bayes for the rest.

Pages with a known outcome are counted per host. The share of bad pages of a host is
shrunk towards that of its registered domain, that one towards its suffix, and that
one towards all pages, each by a beta-binomial prior whose strength is estimated from
the spread between the groups of that level. A url is blocked when the lower bound of
its host's posterior is high enough. Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import keep, without
from rowtide.operators.rows import splittable_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Posterior means less this many standard deviations are compared with the threshold.
BOUND_DEVIATIONS = 1.0
BLOCK_FROM = 0.5

# Correlation of outcomes within a group: strength of the prior is 1 / rho - 1.
LEAST_RHO, MOST_RHO = 0.001, 0.5

# Suffixes of two labels under which names are registered; others are one label.
TWO_LABEL_SUFFIXES = (
    "ac.jp ac.nz ac.uk ac.za co.id co.il co.in co.jp co.ke co.kr co.nz co.th co.uk co.za com.ar com.au com.bd com.br com.cn com.co com.eg "
    "com.hk com.mx com.my com.ng com.pe com.ph com.pk com.pl com.sa com.sg com.tr com.tw com.ua com.ve com.vn edu.au edu.cn go.jp gov.au "
    "gov.br gov.cn gov.in gov.uk govt.nz ltd.uk me.uk ne.jp net.au net.br net.cn net.in net.nz nhs.uk or.jp or.kr org.au org.br org.cn "
    "org.in org.nz org.uk plc.uk sch.uk"
).split()

Rule = tuple[str, str, str]


def host_of(url: str = "url") -> str:
    rest = f"substring({url}, instr({url}, '://') + 3)"
    return (
        f"IF(coalesce(instr({url}, '://'), 0) = 0, '', "
        f"translate(regexp_extract({rest}, '^[^/?#]*', 0), '{UPPER}', '{LOWER}'))"
    )


def path_of(url: str = "url") -> str:
    rest = f"substring({url}, instr({url}, '://') + 3)"
    return f"IF(coalesce(instr({url}, '://'), 0) = 0, '', regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1))"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_case(rules: Sequence[Rule], value: int) -> str:
    """SQL over `host` and `path`: of the rules that fit, the longest one's part `value` (0 verdict, or its text at 1)."""
    cases = []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = (
            f"(host = {_quoted(host)} OR endswith(host, {_quoted('.' + host)})) AND startswith(path, {_quoted(path)})"
        )
        cases.append(f"WHEN {fits} THEN {_quoted((verdict, host + path)[value])}")
    return f"CASE {' '.join(cases)} END" if cases else "CAST(NULL AS STRING)"


def with_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and the rule's `_ruled` verdict (null where none fits)."""
    return (
        without(pages, "host", "path", "rule", "_ruled")
        .selectExpr("*", f"{host_of()} AS host", f"{path_of()} AS path")
        .selectExpr("*", f"{rule_case(rules, 1)} AS rule", f"{rule_case(rules, 0)} AS _ruled")
    )


def _spread(groups: DataFrame, level: str) -> DataFrame:
    """One row: the prior's strength at a level, by the method of moments over groups with `_n` and `_k`."""
    sums = groups.where("_n > 0").selectExpr(
        "sum(_n) AS n", "sum(_k) AS k", "sum(_n * _n) AS nn", "count(*) AS g", "sum(CAST(_k AS DOUBLE) * _k / _n) AS kk"
    )
    rho = sums.selectExpr(
        "*", "CAST(k AS DOUBLE) / n AS p", "n - CAST(nn AS DOUBLE) / n - (g - 1) AS room"
    ).selectExpr("IF(p > 0 AND p < 1 AND room > 0, ((kk - p * k) / (p * (1 - p)) - (g - 1)) / room, NULL) AS rho")
    kept = f"greatest({LEAST_RHO}D, least({MOST_RHO}D, coalesce(rho, {MOST_RHO}D)))"
    return rho.selectExpr(f"round(1 / {kept} - 1, 6) AS _strength_{level}")


def with_domain(hosts: DataFrame, two_label_suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """`hosts` (`host`) with `domain`, the registered one, and `suffix`.

    User, port and a last dot aside, the suffix is the last label, or the last two where these are listed; the domain has one
    label more. A host that is no more than a suffix is a domain of its own. An address is its own domain and suffix.
    """
    bare = "regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*)?[.]?$', '')"
    listed = ", ".join(_quoted(x) for x in two_label_suffixes) or "NULL"
    labels = hosts.selectExpr("*", f"{bare} AS _bare").selectExpr("*", "split(_bare, '[.]') AS _labels")
    cut = labels.selectExpr(
        "*", "_bare RLIKE '^[0-9]+([.][0-9]+){3}$' OR startswith(_bare, '[') AS _address", "array_join(slice(_labels, -least(2, size(_labels)), 2), '.') AS _two"
    ).selectExpr("*", f"IF(coalesce(_two IN ({listed}), FALSE), 2, 1) AS _length")
    last = "array_join(slice(_labels, -least({n}, size(_labels)), {n}), '.')"
    return cut.selectExpr(
        *[f"`{c}`" for c in hosts.columns], f"IF(_address, _bare, {last.format(n='(_length + 1)')}) AS domain",
        f"IF(_address, _bare, {last.format(n='_length')}) AS suffix",
    )


def host_reputation(hosts: DataFrame, two_label_suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """`host`, `mean`, `lower` from hosts with their labelled pages `_n`, of which `_k` were bad (0 for none)."""
    named = with_domain(hosts.select("host", "_n", "_k"), two_label_suffixes)
    domains = named.groupBy("suffix", "domain").agg(F.expr("sum(_n) AS _n"), F.expr("sum(_k) AS _k"))
    suffixes = domains.groupBy("suffix").agg(F.expr("sum(_n) AS _n"), F.expr("sum(_k) AS _k"))
    # One row: the share of all labelled pages, from a flat prior, and the strength of each level's prior.
    whole = keep(
        suffixes.selectExpr("(coalesce(sum(_k), 0) + 1D) / (coalesce(sum(_n), 0) + 2D) AS _all")
        .crossJoin(_spread(suffixes, "suffix"))
        .crossJoin(_spread(domains, "domain"))
        .crossJoin(_spread(named, "host"))
    ).first()
    mean = "(_k + {s}D * {m}) / (_n + {s}D)"
    by_suffix = suffixes.selectExpr("suffix", f"{mean.format(s=whole._strength_suffix, m=f'{whole._all!r}D')} AS _suffix_mean")
    by_domain = splittable_join(domains, by_suffix, ["suffix"], "inner").selectExpr(
        "suffix", "domain", f"{mean.format(s=whole._strength_domain, m='_suffix_mean')} AS _domain_mean"
    )
    joined = splittable_join(named, by_domain, ["suffix", "domain"], "inner").selectExpr(
        "host",
        f"_k + {whole._strength_host}D * _domain_mean AS a",
        f"_n - _k + {whole._strength_host}D * (1D - _domain_mean) AS b",
    )
    return joined.selectExpr("host", "a / (a + b) AS mean", "sqrt(a * b / ((a + b) * (a + b) * (a + b + 1D))) AS _deviation").selectExpr(
        "host", "mean", f"mean - {BOUND_DEVIATIONS}D * _deviation AS lower"
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], outcome: str | None = None, two_label_suffixes: Sequence[str] = TWO_LABEL_SUFFIXES
) -> DataFrame:
    """`pages` with `host`, `path`, `rule`, `verdict`, and the host's `bad_share` and `lower_bound`.

    The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z
    in lower case; the path follows up to `?` or `#`. A null url or one without
    `://` has both empty. `outcome` is SQL over `pages` and the columns of
    `with_rules` that is 1 for a bad page, 0 for a good one and null for an unknown
    one; without it, the pages that a rule decides are the known ones. Columns of
    the input with one of the names above are replaced. Repeated rows count each.
    Without any known outcome every mean is 1/2 and its bound below it: allow. `two_label_suffixes` lists the suffixes of two labels under
    which names are registered. Equal hosts are judged alike; no rows give no rows.
    """
    known = outcome or "CASE _ruled WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END"
    ruled = without(with_rules(pages, rules), "bad_share", "lower_bound", "verdict")
    hosts = keep(
        ruled.selectExpr("host", f"CAST({known} AS INT) AS _bad")
        .groupBy("host")
        .agg(F.expr("count(_bad) AS _n"), F.expr("coalesce(sum(_bad), 0) AS _k"))
    )
    reputation = host_reputation(hosts, two_label_suffixes).selectExpr("host", "mean AS bad_share", "lower AS lower_bound")
    judged = splittable_join(ruled, reputation, ["host"], "inner")
    verdict = f"coalesce(_ruled, IF(lower_bound >= {BLOCK_FROM}D, 'block', 'allow')) AS verdict"
    return judged.selectExpr("*", verdict).drop("_ruled")
