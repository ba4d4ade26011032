"""Secret scans with multipart credential linking, in built-in functions only.

Base kinds are reported wherever they match. Weak kinds (identifiers, bare high-variety
strings, endpoints) mean little alone: each is a part, and a weak part is reported only when a
complementary part lies within its scope, at most ``scope`` code points before its start or
after its end, however long it is, and apart from it: parts that overlap do not complete each
other. An address holds many long runs that are no secrets, so inside one only the password of
its user info or a value of its query is a part (``url_secret``), complete with the address
around it; an assigned secret in its query completes the address too. That is an interval join: parts are put into bins of the
scope's width, and a weak part semi-joins the parts of its bins on the exact interval. A
semi-join gives a part at most once a bin, and a bin holds a bounded number of spans, so there
are never all pairs of a group.

Positions come from the pieces between matches (``split``) and the matches themselves
(``regexp_extract_all``), summed up; both read the whole text. Sums over the matches of a text
are taken chunk by chunk, so a text with very many matches costs time in proportion to them.

Defined results: a null text is empty; no match gives zero counts, the hash of the empty
string and an empty span list; equal texts, rows and ids are judged row by row; a null doc_id
stays null; an empty table gives an empty result; extra columns are ignored by the scan and
kept by the redaction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import let, materialise, text_of

#: Base kinds, in the order in which they are listed at one start.
BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9+/_.=-]+))""",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]+)",
}
_LEAST = {"access": 20, "hex": 24}   # code points of a match
_ASSIGN_VALUE = 6                    # code points of the assigned value

_SCHEMES = "https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp"
_RUN = "[A-Za-z0-9+/_-]{32,}+={0,2}+(?![A-Za-z0-9+/=_-])"
_MIXED = r"(?s)^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"

#: Weak kinds: what they look like, and what an extra test asks of the part that counts.
WEAK = {
    "key_id": (r"""((?:\b|(?<=_))(?i:client|access|account|user|login)_?(?i:id|key_?id|name)["']?"""
               r"""\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,})""", None),
    # A run may follow the '=' of NAME=VALUE and has any length; what '=' follows is padding.
    # Addresses are matched whole, so that runs inside them are passed over: see group 2.
    "secret_part": (rf"""((?i:{_SCHEMES})://[^\x20\x09-\x0D"'<>]+|"""
                    rf"""((?<![A-Za-z0-9+/_-]){_RUN}))""", _MIXED),
    "url_secret": (rf"((?<=[:=])(?!/){_RUN})", _MIXED),
    "endpoint": (rf"((?i:{_SCHEMES})://[A-Za-z0-9._:@%/?&=+-]{{4,}})", None),
}
KINDS = [*BASE, *WEAK]
#: Kinds whose group 2 is the part that counts.
_SECOND = ("assign", "secret_part")
_ROLE = {"assign": "secret", "hex": "secret", "secret_part": "secret", "access": "id",
         "key_id": "id", "endpoint": "endpoint", "url_secret": "in_url"}
#: A part of the first role is complete with one of the others, within scope and apart from it.
COMPLEMENT = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}
#: An endpoint is complete with one of these inside it, and the first with an endpoint around it.
INSIDE = ("url_secret", "assign")

_SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Settings:
    scope: int = 200          # code points on either side of a weak part
    mask: str = "[SECRET]"


#: Elements of an array that are summed at once; see ``before_each``.
_CHUNK = 64


def before_each(values: Column, zero: Column, op) -> Column:
    """For each element of an array the combination by ``op`` of all earlier ones.

    An accumulator that appends to an array copies it each time. So chunks are combined on
    their own first, then their totals, then the elements inside each chunk."""
    def running(items: Column, start: Column) -> Column:
        none = F.struct(start.alias("acc"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, none, lambda s, x: F.struct(
            op(s["acc"], x).alias("acc"), F.concat(s["out"], F.array(s["acc"])).alias("out")),
            lambda s: s["out"])

    last = F.floor((F.size(values) - 1) / _CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last),
                         lambda i: F.slice(values, i * _CHUNK + 1, _CHUNK))
    made = let(chunks, lambda c: F.flatten(F.zip_with(
        c, running(F.transform(c, lambda x: F.aggregate(x, zero, op)), zero), running)))
    return F.when(F.size(values) > 0, made).otherwise(F.array().cast("array<int>"))


def _positions(text: Column, pattern: str, kind: str, keep: Column | None) -> Column:
    """Spans of all matches of ``pattern``; ``keep`` says of each match (m, v) whether it stays."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind in _SECOND else 1))
    code = KINDS.index(kind)

    def spans(m: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern), 1, F.size(m)), F.length)
        sizes = F.transform(m, F.length)

        def placed(g: Column) -> Column:
            at = before_each(F.zip_with(g, sizes, lambda a, b: a + b), F.lit(0), lambda a, b: a + b)
            return F.arrays_zip(m.alias("m"), value.alias("v"), g.alias("g"), at.alias("at"))
        rows = let(gaps, placed)
        rows = rows if keep is None else F.filter(rows, keep)
        return F.transform(rows, lambda x: F.struct(
            (x["at"] + x["g"]).alias("start"), F.lit(code).alias("kind"),
            (x["at"] + x["g"] + F.length(x["m"])).alias("end")))

    return F.when(text.rlike(pattern), let(found, spans)).otherwise(F.array().cast(_SPANS))


def _base_spans(text: Column, kind: str) -> Column:
    if kind == "assign":
        keep = lambda x: F.length(x["v"]) >= _ASSIGN_VALUE
        return _positions(text, BASE[kind], kind, keep)
    # The runs are maximal, so a failing match hides no other: ask for the length at once.
    least = _LEAST[kind] - (len("AKIA") if kind == "access" else 0)
    return _positions(text, BASE[kind].replace("+", f"{{{least},}}"), kind, None)


def _weak_spans(text: Column, kind: str) -> Column:
    pattern, test = WEAK[kind]
    return _positions(text, pattern, kind, test and (lambda x: x["v"].rlike(test)))


def with_parts(docs: DataFrame) -> DataFrame:
    """``docs`` with __text, __base (sorted spans) and __weak (unlinked weak spans)."""
    text = F.col("__text")
    return docs.withColumn("__text", text_of()).withColumns({
        "__base": F.sort_array(F.concat(*[_base_spans(text, k) for k in BASE])),
        "__weak": F.concat(*[_weak_spans(text, k) for k in WEAK])})


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(_ROLE[k]) for k in KINDS]), kind + 1)


def linked_parts(rows: DataFrame, settings: Settings) -> DataFrame:
    """(rid, linked): weak spans with a complementary part in scope, from rid, __base, __weak.

    Only texts with a weak part are looked at. The join's key is (row, bin), so a text with
    very many parts is spread over many keys.
    """
    r = settings.scope
    rows = rows.filter(F.size("__weak") > 0)
    parts = rows.select("rid", F.explode(F.concat("__base", "__weak")).alias("s")).select(
        F.col("rid").alias("__rid"), _role(F.col("s.kind")).alias("__role"),
        F.col("s.kind").isin([KINDS.index(k) for k in INSIDE]).alias("__inside"),
        F.col("s.start").alias("__from"), F.col("s.end").alias("__to"),
        F.explode(F.sequence(F.floor((F.col("s.start") - r) / r),
                             F.floor((F.col("s.end") + r) / r))).alias("__bin"))
    weak = rows.select("rid", F.explode("__weak").alias("s")).select(
        "rid", "s", _role(F.col("s.kind")).alias("role"),
        F.explode(F.sequence(F.floor(F.col("s.start") / r),
                             F.floor(F.col("s.end") / r))).alias("bin"))
    fits = F.lit(False)
    for role, others in COMPLEMENT.items():
        fits = fits | ((F.col("role") == role) & F.col("__role").isin(*others))
    start, end, low, high = (F.col(c) for c in ("s.start", "s.end", "__from", "__to"))
    near = (start <= high + r) & (end >= low - r) & ((start >= high) | (end <= low))
    holds = ((F.col("role") == "endpoint") & F.col("__inside") & (start <= low) & (high <= end)) | \
        ((F.col("role") == "in_url") & (F.col("__role") == "endpoint") & (low <= start) & (end <= high))
    joined = weak.join(parts, (F.col("rid") == F.col("__rid")) & (F.col("bin") == F.col("__bin"))
                       & ((fits & near) | holds), "left_semi")
    return joined.groupBy("rid").agg(F.collect_set("s").alias("linked"))


def _listing(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name(s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, all spans, linked spans."""
    settings = settings or Settings()
    rows = materialise(with_parts(docs.select("doc_id", "text"))
                       .select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                               "__base", "__weak"), "parts")
    linked = linked_parts(rows, settings).withColumnRenamed("rid", "__r")
    out = rows.join(linked, F.col("rid") == F.col("__r"), "left")
    empty = F.array().cast(_SPANS)
    out = out.withColumn("__all", F.sort_array(
        F.concat("__base", F.coalesce(F.col("linked"), empty))))
    of = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    return out.select("doc_id", *[of(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                      F.sha2(_listing(F.col("__base")), 256).alias("base_sha256"),
                      _listing(F.col("__all")).alias("spans"),
                      F.size(F.coalesce(F.col("linked"), empty)).cast("long").alias("n_linked"))


#: Code points of a piece of text that is cut from; see ``masked``.
_PIECE = 1000


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with the union of the sorted spans replaced, each stretch by one mask.

    What stays is cut from short pieces of the text, as a cut from a long string reads it from
    its start each time."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{_PIECE}}})"), F.lit(1))
    covered = before_each(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
    stretches = F.filter(F.arrays_zip(spans.alias("s"), covered.alias("to")),
                         lambda x: x["s"]["start"] >= x["to"])

    def cut(p: Column, lo: Column, hi: Column) -> Column:
        first = F.floor(lo / _PIECE).cast("int")
        some = F.slice(p, first + 1, F.floor(hi / _PIECE).cast("int") - first + 1)
        return F.array_join(some, "").substr(lo - first * _PIECE + 1, hi - lo)

    def joined(p: Column) -> Column:
        kept = F.transform(stretches, lambda x: F.concat(
            F.when(x["s"]["start"] > x["to"], cut(p, x["to"], x["s"]["start"])).otherwise(""),
            F.lit(mask)))
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        rest = F.when(F.length(text) > end, cut(p, end, F.length(text))).otherwise("")
        return F.concat(F.array_join(kept, ""), rest)

    return let(pieces, joined)


def redact(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` masked, ``n_chars`` (if any) anew.

    Rows without weak parts are masked in the scan. Those with some are written apart, linked,
    and masked from there, so no text is joined back by an id that may repeat.
    """
    settings = settings or Settings()
    own = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row")
    parted = with_parts(docs.select(row, F.col("text")))
    plain = parted.filter(F.size("__weak") == 0).select("__row", "__text", "__base")
    weak = materialise(parted.filter(F.size("__weak") > 0)
                       .withColumn("rid", F.monotonically_increasing_id()), "weak")
    linked = linked_parts(weak, settings).withColumnRenamed("rid", "__r")
    joined = weak.join(linked, F.col("rid") == F.col("__r"), "left").select(
        "__row", "__text", F.sort_array(F.concat(
            "__base", F.coalesce("linked", F.array().cast(_SPANS)))).alias("__base"))
    out = plain.unionByName(joined).withColumn("__new", F.when(
        F.size("__base") > 0, masked(F.col("__text"), F.col("__base"), settings.mask)))
    new = {"text": F.coalesce("__new", F.col("__row.text").cast("string"))}
    if "n_chars" in own:
        new["n_chars"] = F.when(F.col("__new").isNotNull(), F.length("__new").cast("long")) \
            .otherwise(F.col("__row.n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col("__row")[c].alias(c) for c in own])
