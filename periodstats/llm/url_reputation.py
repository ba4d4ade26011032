"""URL filters by empirical-Bayes host reputation, with explicit rules in front.

Labelled page outcomes (1 good, 0 bad) are counted per host. Going down from the whole table
to suffix, registered domain and host, each level's share of bad pages gets a beta prior: its
mean is the posterior mean of the level above, its strength (pseudo-pages) is estimated from
how far the children's shares scatter beyond binomial noise (method of moments), kept within
bounds. A host is blocked if the lower bound of its posterior share of bad pages, mean minus
``z`` standard deviations of the beta posterior, exceeds ``bad_share``. An unseen host has the
posterior of the closest level above that was seen.

All counts are aggregations with partial sums before the shuffle; the table of hosts is
written, so the join with the pages broadcasts it only if it measures small and otherwise
splits a hot host.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and the
method's verdict for the empty host; null labels are ignored; a page with several labels
counts each; repeated pages get a row each; without any label every verdict is allow; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import materialise

#: (verdict, host, path prefix); the longest host + path that fits decides.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
         ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: Rules are part of the expression, so their number is bounded.
MOST_RULES = 1000

LEVELS = ["suffix", "domain", "host"]


@dataclass(frozen=True)
class Settings:
    bad_share: float = 0.5
    z: float = 1.645
    least_strength: float = 2.0
    most_strength: float = 200.0
    two_part_suffixes: tuple[str, ...] = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")


_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(pages: DataFrame, settings: Settings) -> DataFrame:
    """page_id, host, path, name (the host without user info and port), domain (registered),
    suffix."""
    at = F.instr("url", "://")
    rest = F.when(F.col("url").isNotNull() & (at > 0), F.expr(
        "substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    df = pages.select("page_id", rest.alias("__rest"))
    host = F.regexp_extract("__rest", r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    df = df.select("page_id", F.translate(host, *_LOWER).alias("host"), path.alias("path"))
    name = F.regexp_replace(F.substring_index("host", "@", -1), r":[0-9]*$", "")
    df = df.withColumn("name", name)
    two = F.substring_index("name", ".", -2)
    double = two.isin(*settings.two_part_suffixes) if settings.two_part_suffixes else F.lit(False)
    return df.withColumns({
        "suffix": F.when(double, two).otherwise(F.substring_index("name", ".", -1)),
        "domain": F.when(double, F.substring_index("name", ".", -3)).otherwise(two)})


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules; join a rule table for more")
    if not rules:
        return F.lit(None).cast("struct<verdict:string,host:string,path:string,rule:string>")
    known = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"),
                               F.lit(p).alias("path"), F.lit(h + p).alias("rule"))
                      for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))])
    fits = F.filter(known, lambda r: (
        (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
        & F.startswith(path, r["path"]))
    return F.get(fits, 0)


def _level(counts: DataFrame, parent: DataFrame | float, keys: list[str],
           settings: Settings) -> DataFrame:
    """Posterior (a, b) of each member of a level (last of ``keys``) from its counts and the
    mean of its parent (first of ``keys``), or of the whole table.

    The scatter of the children around their parents' means, less binomial noise, gives the
    strength of the prior; it is one number a level.
    """
    level, above = keys[-1], keys[0]
    sums = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    if isinstance(parent, float):
        df = sums.withColumn("prior", F.lit(parent))
    else:
        up = parent.select(F.col(above).alias("__above"), F.col("mean").alias("prior"))
        df = sums.join(up, F.col(above) == F.col("__above")).drop("__above")
    # E[(bad - n p)^2] = n p q (1 + (n - 1) rho), and strength = 1 / rho - 1.
    noise = F.col("n") * F.col("prior") * (1 - F.col("prior"))
    scatter = df.agg(F.sum((F.col("bad") - F.col("n") * F.col("prior")) ** 2).alias("seen"),
                     F.sum(noise).alias("noise"),
                     F.sum(noise * (F.col("n") - 1)).alias("room")).first()
    rho = ((scatter["seen"] or 0.0) - (scatter["noise"] or 0.0)) / scatter["room"] \
        if scatter["room"] else 0.0
    strength = 1 / rho - 1 if rho > 1e-9 else settings.most_strength
    strength = min(max(strength, settings.least_strength), settings.most_strength)
    a = F.col("bad") + F.col("prior") * strength
    b = F.col("n") - F.col("bad") + (1 - F.col("prior")) * strength
    return materialise(df.select(level, a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean")),
                       f"reputation-{level}")


def _bound(a: Column, b: Column, z: float) -> Column:
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def reputation(pages: DataFrame, outcomes: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """Per level the bad share's posterior; ``pages`` as from ``parsed``, outcomes (page_id, bad).

    The outcomes of a page_id are counted before the join and count once for each host that the
    id occurs on, however many rows carry it: rows never multiply."""
    known = outcomes.groupBy(F.col("page_id").alias("__id")).agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    # Port and user info are no part of a name that reputation is kept for.
    hosts = pages.where("page_id IS NOT NULL").select(
        "page_id", "suffix", "domain", F.col("name").alias("host")).distinct()
    counts = (hosts.join(known, F.col("page_id") == F.col("__id"))
              .groupBy("suffix", "domain", "host")
              .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    counts = materialise(counts, "reputation-counts")
    total = counts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    share = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    out = {"suffix": _level(counts, share, ["suffix"], settings)}
    out["domain"] = _level(counts, out["suffix"], ["suffix", "domain"], settings)
    out["host"] = _level(counts, out["domain"], ["domain", "host"], settings)
    return out


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]],
               settings: Settings | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, posterior mean and lower bound of the bad share (the
    last two rounded to 6 digits; the verdict is of the unrounded bound)."""
    settings = settings or Settings()
    df = parsed(pages.select("page_id", "url"), settings)
    levels = reputation(df, outcomes, settings)
    for level in LEVELS:
        side = levels[level].select(F.col(level).alias(f"__{level}"),
                                    F.struct("a", "b").alias(f"post_{level}"))
        mine = "name" if level == "host" else level
        df = df.join(side, F.col(mine) == F.col(f"__{level}"), "left").drop(f"__{level}")
    post = F.coalesce("post_host", "post_domain", "post_suffix")
    df = df.withColumn("__p", post).withColumns({
        "bad_share": F.col("__p.a") / (F.col("__p.a") + F.col("__p.b")),
        "bad_bound": _bound(F.col("__p.a"), F.col("__p.b"), settings.z),
        "__rule": rule_for(F.col("host"), F.col("path"), rules)})
    own = F.when(F.col("bad_bound") > settings.bad_share, "block").otherwise("allow")
    return df.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"),
                     F.coalesce(F.col("__rule.verdict"), own).alias("verdict"),
                     F.round("bad_share", 6).alias("bad_share"),
                     F.round("bad_bound", 6).alias("bad_bound"))


def oracle_sql(settings: Settings | None = None, digits: int = 6) -> str:
    """The same in DuckDB for outcomes from ``labels``; posteriors rounded to ``digits``."""
    s = settings or Settings()
    two = ", ".join(f"'{x}'" for x in s.two_part_suffixes) or "NULL"
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

    def level(name: str, above: str | None) -> str:
        keys = f"{above}, {name}" if above else name
        source = (f"SELECT c.{name}, sum(n) AS n, sum(bad) AS bad, any_value(u.mean) AS prior "
                  f"FROM counts c JOIN p_{above} u USING ({above}) GROUP BY {keys}" if above else
                  f"SELECT {name}, sum(n) AS n, sum(bad) AS bad, (SELECT share FROM total) AS prior "
                  f"FROM counts GROUP BY {name}")
        return f"""
s_{name} AS ({source}),
m_{name} AS (
  SELECT sum((bad - n * prior) ** 2) AS seen, sum(n * prior * (1 - prior)) AS noise,
         sum(n * prior * (1 - prior) * (n - 1)) AS room FROM s_{name}),
r_{name} AS (SELECT CASE WHEN room > 0 THEN (seen - noise) / room ELSE 0 END AS rho FROM m_{name}),
t_{name} AS (SELECT least(greatest(CASE WHEN rho > 1e-9 THEN 1 / rho - 1 ELSE {s.most_strength} END,
                                   {s.least_strength}), {s.most_strength}) AS strength FROM r_{name}),
p_{name} AS (
  SELECT {name}, bad + prior * strength AS a, n - bad + (1 - prior) * strength AS b,
         (bad + prior * strength) / (n + strength) AS mean FROM s_{name}, t_{name})"""

    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END
    AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{_LOWER[0]}',
                            '{_LOWER[1]}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
named AS (SELECT *, regexp_replace(string_split(host, '@')[-1], ':[0-9]*$', '') AS name FROM split),
parts AS (SELECT *, string_split(name, '.') AS w FROM named),
parsed AS (
  SELECT page_id, host, path, name,
    CASE WHEN two IN ({two}) THEN two ELSE w[-1] END AS suffix,
    CASE WHEN two IN ({two}) THEN array_to_string(w[-3:], '.') ELSE two END AS domain
  FROM (SELECT *, array_to_string(w[-2:], '.') AS two FROM parts)),
known AS (SELECT doc_id AS page_id, count(*) AS n, count_if(quality = 0) AS bad FROM labels
          WHERE quality IS NOT NULL GROUP BY 1),
counts AS (
  SELECT suffix, domain, name AS host, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
  FROM (SELECT DISTINCT page_id, suffix, domain, name FROM parsed) JOIN known USING (page_id)
  GROUP BY 1, 2, 3),
total AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS share FROM counts),
{level("suffix", None).strip()},{level("domain", "suffix")},{level("host", "domain")},
rules AS (SELECT * FROM (VALUES {rules}) v(verdict, rhost, rpath)),
ruled AS (
  SELECT page_id, host, path, name, suffix, domain, (
    SELECT {{'rule': rhost || rpath, 'verdict': verdict}} FROM rules
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    ORDER BY length(rhost || rpath) DESC, verdict, rhost, rpath LIMIT 1) AS r FROM parsed),
judged AS (
  SELECT page_id, j.host, path, r, coalesce(h.a, d.a, x.a) AS a, coalesce(h.b, d.b, x.b) AS b
  FROM ruled j LEFT JOIN p_host h ON h.host = j.name LEFT JOIN p_domain d ON d.domain = j.domain
  LEFT JOIN p_suffix x ON x.suffix = j.suffix),
bounded AS (
  SELECT *, a / (a + b) AS mean,
         a / (a + b) - {s.z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS low FROM judged)
SELECT page_id, host, path, r.rule AS rule,
  coalesce(r.verdict, CASE WHEN low > {s.bad_share} THEN 'block' ELSE 'allow' END) AS verdict,
  round(mean, {digits}) AS bad_share, round(low, {digits}) AS bad_bound
FROM bounded"""
