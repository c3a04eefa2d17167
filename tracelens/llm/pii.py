"""Personal data: base patterns, and more identifiers by bootstrapped contexts. DataFrame functions only.

Base spans are what four regular expressions find, leftmost and without
overlap in a kind, less the matches that fail a check (parts of an address,
length and Luhn sum of a card, digits of a phone number). They are the seeds.

Bootstrapping, over all documents:

* entities are the seeds and the other identifier-like tokens (white-space
  separated, with a digit or ``@``, punctuation at the ends stripped);
* an entity's lexical patterns are its two words to the left, and its word to
  the left with its word to the right, of the text itself for seeds and tokens alike;
* patterns and instances (the entities' text) make a graph. A seed scores 1
  for its kind. In each round, a pattern scores the mean of its instances for
  the kind, smoothed towards 0, and any other instance one minus the product
  of its patterns' doubts;
* a pattern takes part from the round on in which it has at least ``SUPPORT``
  distinct instances of a kind that are seeds, or that a confident pattern of
  the round before took;
* at the end, such a pattern with a score of at least ``CONFIDENCE`` takes the
  tokens in its places as that kind, unless a base span overlaps them.

The regular expressions are written so that they find the same as the plain
ones in linear time and without deep recursion: a run of characters that
failed from its start is not tried again from its middle, and quantifiers
don't give back what can't help.

Texts are read once; entities go to a staged table, the graph holds each
(pattern, instance) once with its count, scores are staged each round, so hot
patterns meet tables of one row a pattern, a join that Spark splits. Null counts as
empty; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

KINDS = ["email", "ip", "card", "phone"]

# The task's patterns, with possessive quantifiers and starts only where a match can begin.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched for a kind.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_TOKEN = r"(?<!\S)(?=\S*?[0-9@])\S++"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: A piece of text with up to 32 words and what is between them: pieces follow each other without a gap and cut no word.
_PIECE = r"(?:[^\p{L}\p{N}]*+[\p{L}\p{N}]++){1,32}+[^\p{L}\p{N}]*+"

ROUNDS = 3
SUPPORT = 5
CONFIDENCE = 0.8
_SMOOTH = 1.0


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _running(values: Column) -> Column:
    """Running sums of an array of ints, in chunks: the lists that grow stay short however many values there are."""
    chunk = 256

    def scan(part: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.expr("CAST(array() AS array<int>)").alias("all"))
        grown = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"] + x)).alias("all"))
        return F.aggregate(part, begin, grown)["all"]

    last = F.greatest(F.ceil(F.size(values) / F.lit(chunk)).cast("int") - 1, F.lit(0))
    parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * chunk + 1, chunk))
    upto = scan(F.transform(parts, _sum), F.lit(0))
    return F.flatten(F.zip_with(parts, upto, lambda p, end: scan(p, end - _sum(p))))


def _running_max(values: Column) -> Column:
    """Running maxima of an array of ints that aren't negative, in chunks as :func:`_running`."""
    chunk = 256

    def scan(part: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.expr("CAST(array() AS array<int>)").alias("all"))
        grown = lambda a, x: F.struct(F.greatest(a["at"], x).alias("at"), F.concat(a["all"], F.array(F.greatest(a["at"], x))).alias("all"))
        return F.aggregate(part, begin, grown)["all"]

    last = F.greatest(F.ceil(F.size(values) / F.lit(chunk)).cast("int") - 1, F.lit(0))
    parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * chunk + 1, chunk))
    upto = scan(F.transform(parts, lambda p: F.coalesce(F.array_max(p), F.lit(0))), F.lit(0))
    before = F.concat(F.array(F.lit(0)), F.slice(upto, F.lit(1), F.size(upto) - 1))
    return F.flatten(F.zip_with(parts, before, scan))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.coalesce(_sum(F.filter(each, lambda v: v.isNotNull())), F.lit(1)) % 10 == 0


def _checked(kind: str):
    return lambda span: _valid(kind, span["found"])


def _named(kind: str):
    return lambda span: F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), span["found"].alias("found"))


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _with_spans(rows: DataFrame, patterns: dict[str, str], needs: dict[str, str]) -> DataFrame:
    """Adds for each name an array of its matches in ``text``: (start, end, found) in code points."""
    columns = rows.columns
    here = {k: F.col("text").contains(v) if v else F.lit(True) for k, v in needs.items()}
    found = rows.select(
        *columns,
        *(F.when(here[k], F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.expr("CAST(array() AS array<string>)")).alias(f"_m_{k}") for k, p in patterns.items()),
    )
    gaps = found.select(
        *found.columns,
        *(F.when(F.size(f"_m_{k}") > 0, F.transform(F.split("text", p, -1), F.length)).alias(f"_g_{k}") for k, p in patterns.items()),
    )
    sizes = gaps.select(*gaps.columns, *(F.when(F.col(f"_g_{k}").isNotNull(), F.zip_with(f"_m_{k}", F.slice(f"_g_{k}", F.lit(1), F.size(f"_m_{k}")), lambda m, g: F.length(m) + g)).alias(f"_n_{k}") for k in patterns))
    ends = sizes.select(*sizes.columns, *(F.when(F.col(f"_n_{k}").isNotNull(), _running(F.col(f"_n_{k}"))).alias(f"_e_{k}") for k in patterns))

    def spans(k: str) -> Column:
        m, e = (F.col(f"_{x}_{k}") for x in "me")
        one = lambda i: F.struct((e[i] - F.length(m[i])).alias("start"), e[i].alias("end"), m[i].alias("found"))
        none = F.expr("CAST(array() AS array<struct<start:int,end:int,found:string>>)")
        return F.when(e.isNotNull(), F.transform(F.sequence(F.lit(0), F.size(m) - 1), one)).otherwise(none).alias(k)

    return ends.select(*columns, *(spans(k) for k in patterns))


def _piece_at(ends: Column, place: Column) -> Column:
    """Number of the piece that holds a place, by halving: pieces that end at the place or before it."""

    def halve(a: Column, _: Column) -> Column:
        middle = F.shiftright(a["low"] + a["high"], 1)
        right = F.coalesce(F.get(ends, middle) <= place, F.lit(False)) & (a["low"] < a["high"])
        return F.struct(F.when(right, middle + 1).otherwise(a["low"]).alias("low"), F.when(right, a["high"]).otherwise(middle).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(26)), F.struct(F.lit(0).alias("low"), F.size(ends).alias("high")), halve)["low"]


def _with_surroundings(rows: DataFrame) -> DataFrame:
    """Adds to each of ``entities`` the text before and behind it, from the pieces that hold its start and end and those next to them."""
    others = [c for c in rows.columns if c not in ("entities", "text")]
    none = F.expr("CAST(array() AS array<string>)")
    cut = rows.select(*others, "entities", F.when(F.size("entities") > 0, F.regexp_extract_all("text", F.lit(_PIECE), F.lit(0))).otherwise(none).alias("_pieces"))
    ended = cut.select(*others, "entities", "_pieces", _running(F.transform("_pieces", F.length)).alias("_ends"))
    pieces, ends = F.col("_pieces"), F.col("_ends")
    places = F.transform("entities", lambda e: F.struct(e.alias("e"), _piece_at(ends, e["start"]).alias("first"), _piece_at(ends, e["end"]).alias("last")))
    placed = ended.select(*others, places.alias("entities"), "_pieces", "_ends")
    piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
    begin = lambda k: F.coalesce(F.get(ends, k - 1), F.lit(0))

    def one(x: Column) -> Column:
        e, first, last = x["e"], x["first"], x["last"]
        before = F.concat(piece(first - 1), F.substr(piece(first), F.lit(1), e["start"] - begin(first)))
        behind = F.concat(F.substr(piece(last), e["end"] - begin(last) + 1), piece(last + 1))
        return F.struct(*(e[c].alias(c) for c in ("kind", "start", "end", "found")), before.alias("before"), behind.alias("behind"))

    return placed.select(*others, F.transform("entities", one).alias("entities"))


def _context(span: Column) -> tuple[Column, Column, Column]:
    """The two words before and the one behind a span, lower case; a mark where the text has none."""
    words = lambda text: F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    before, behind = words(span["before"]), words(span["behind"])
    back = lambda k: F.coalesce(F.try_element_at(before, F.lit(-k)), F.lit("^"))
    return back(2), back(1), F.coalesce(F.try_element_at(behind, F.lit(1)), F.lit("$"))


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A staged row per document: row, doc_id, the valid base spans of each kind, and all entities with their patterns."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = _with_spans(rows, PATTERNS | {"token": _TOKEN}, _NEEDS | {"token": ""})
    valid = spans.select("row", "doc_id", "text", "token", *(F.filter(k, _checked(k)).alias(k) for k in KINDS))
    seeds = [F.transform(k, _named(k)) for k in KINDS]
    lead = lambda s: F.length(F.regexp_extract(s["found"], r"^[^\p{L}\p{N}+@]*+", 0))
    body = lambda s: F.regexp_replace(s["found"], r"^[^\p{L}\p{N}+@]++|(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
    tokens = F.transform("token", lambda s: F.struct(F.lit("").alias("kind"), (s["start"] + lead(s)).alias("start"), (s["start"] + lead(s) + F.length(body(s))).alias("end"), body(s).alias("found")))
    by_start = F.array_sort(F.transform(reduce(F.concat, seeds), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["found"].alias("found"))))
    sorted_ = valid.withColumn("_by_start", by_start).withColumn("tokens", tokens)
    known = sorted_.withColumns({
        "seeds": F.transform("_by_start", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"))),
        "_starts": F.transform("_by_start", lambda s: s["start"]), "_reach": _running_max(F.transform("_by_start", lambda s: s["end"])),
    })
    # Of the seeds that begin before the token's end, the one that reaches furthest: halving instead of a look at each.
    reached = lambda t: F.coalesce(F.get("_reach", _piece_at(F.col("_starts"), t["end"] - 1) - 1), F.lit(0))
    fresh = F.filter("tokens", lambda t: (t["start"] < t["end"]) & (reached(t) <= t["start"]))

    def with_patterns(e: Column) -> Column:
        l2, l1, r1 = _context(e)
        return F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end"), F.lower(e["found"]).alias("found"), F.array(F.concat(l2, F.lit(" "), l1, F.lit(" _")), F.concat(l1, F.lit(" _ "), r1)).alias("patterns"))

    near = _with_surroundings(known.select("row", "doc_id", *KINDS, "text", F.concat(F.col("seeds"), fresh).alias("entities")))
    whole = near.select("row", "doc_id", *KINDS, F.transform("entities", with_patterns).alias("entities"))
    return stage_table(whole, "pii-entities")


def strong_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(pattern, kind, score) of the patterns that may take unseen identifiers, from :func:`entities`."""
    places = found.select(F.explode("entities").alias("e")).select(F.explode("e.patterns").alias("pattern"), F.col("e.found").alias("instance"), F.col("e.kind").alias("of"))
    edges = stage_table(places.groupBy("pattern", "instance", "of").agg(F.count(F.lit(1)).alias("n")), "pii-edges")
    known = edges.where("of <> ''").select("pattern", F.col("of").alias("kind"), "instance")
    sure = scores = None
    for k in range(rounds):
        # A pattern is backed by the distinct seeds and the sure discovered instances in its places: each round takes in those that the last one's finds back.
        if sure is not None:
            own = edges.where("of = ''").select("pattern", "instance").join(sure.select("instance", "kind"), "instance")
            known = edges.where("of <> ''").select("pattern", F.col("of").alias("kind"), "instance").unionByName(own.select("pattern", "kind", "instance")).distinct()
        backed = stage_table(known.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("backing")).where(F.col("backing") >= support), "pii-backed")
        graph = edges.join(backed.select("pattern", "kind"), "pattern")
        if scores is None:
            rated = graph.withColumn("instance_score", F.when(F.col("of") == F.col("kind"), 1.0).otherwise(0.0))
        else:
            doubts = edges.where("of = ''").join(scores, "pattern").groupBy("instance", "kind").agg(F.product(F.lit(1.0) - F.col("score")).alias("doubt"))
            doubts = stage_table(doubts, "pii-doubts")
            rated = graph.join(doubts, ["instance", "kind"], "left").withColumn(
                "instance_score", F.when(F.col("of") == F.col("kind"), 1.0).when(F.col("of") == "", 1 - F.coalesce("doubt", F.lit(1.0))).otherwise(0.0)
            )
        scores = stage_table(rated.groupBy("pattern", "kind").agg((F.sum("instance_score") / (F.count(F.lit(1)) + F.lit(_SMOOTH))).alias("score")), "pii-scores")
        if k + 1 < rounds:
            strong = scores.where(F.col("score") >= confidence)
            sure = stage_table(edges.where("of = ''").join(strong, "pattern").select("instance", "kind").distinct(), "pii-sure")
    return scores.where(F.col("score") >= confidence)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per document: doc_id, base and found, arrays of (kind, start, end) by kind as listed, then start."""
    rows = entities(docs, id_col, text_col)
    strong = strong_patterns(rows, rounds, support, confidence)
    tokens = rows.select("row", F.explode("entities").alias("e")).where("e.kind = ''").select("row", F.col("e.start").alias("start"), F.col("e.end").alias("end"), F.explode("e.patterns").alias("pattern"))
    taken = tokens.join(strong, "pattern").groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    extra = taken.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("found"))
    order = {k: i for i, k in enumerate(KINDS)}
    rank = lambda c: reduce(lambda a, k: a.when(c == k, order[k]), KINDS[1:], F.when(c == KINDS[0], 0))
    base = F.transform(reduce(F.concat, [F.transform(k, _named(k)) for k in KINDS]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    keyed = F.transform(F.concat("base", "found"), lambda s: F.struct(rank(s["kind"]).alias("by"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    whole = rows.withColumn("base", base).select("row", "doc_id", "base").join(extra, "row", "left")
    whole = whole.withColumn("found", F.coalesce("found", F.expr("CAST(array() AS array<struct<kind:string,start:int,end:int>>)")))
    return whole.select("doc_id", "base", F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("found"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
