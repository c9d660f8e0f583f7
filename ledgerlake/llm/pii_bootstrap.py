"""Personal data by bootstrapped contextual extraction.

Four kinds of identifiers are found by their form. Those that stand alone between words seed a
graph of lexical patterns (the words around a place) and instances (what stands there). A pattern
is trusted for a kind when nearly all its different instances are of that kind; trusted patterns
give their other instances the kind, which in turn count for further patterns. Only DataFrame
functions; rounds are joins and map-side sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stage
from ledgerlake.operators.lookup import hot_keys, key_counts, left_lookup

KINDS = ("email", "ip", "card", "phone")
#: The contract's forms. Starts inside a run of the same characters are ruled out and repeats
#: never give back, which finds the same leftmost matches in linear time, at any length.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Neighbouring words that hold a digit or an at-sign: what an identifier may be.
_RUN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\s[^\s0-9@]*+[0-9@]\S*+)*+"
_LEAD = r"^[^0-9A-Za-z+(@]++"
_TRAIL = r"(?<![^0-9A-Za-z)])[^0-9A-Za-z)]++$"
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
LONGEST = 64  # code points of an identifier that only its context shows
TRUST = 0.8  # share of a pattern's instances that must be of one kind, one more counted against it
SUPPORT = 3  # instances of the kind that a trusted pattern has at least
ROUNDS = 5


def _valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's form counts."""
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]+", "")).between(9, 15)
    if kind == "card":
        digits = F.reverse(F.regexp_replace(value, r"[\x20-]", ""))

        def luhn(total: Column, i: Column) -> Column:
            digit = F.substr(digits, i, F.lit(1)).cast("int")
            twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return total + F.when(i % 2 == 0, twice).otherwise(digit)

        checked = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), luhn) % 10 == 0
        return F.when(F.length(digits).between(13, 19), checked).otherwise(F.lit(False))
    return F.lit(True)


def _check(kind: str):
    return lambda value: _valid(kind, value)


def _pieces(body: Column, form: str, needed: Column, piece) -> Column:
    """Each match of a form ("0") with what ``piece`` makes of the texts before and after it ("1", "2")."""
    matches = F.when(needed, F.regexp_extract_all(body, F.lit(form), F.lit(0)))
    pieces = F.transform(F.split(body, form, -1), piece)
    n = F.size(matches)
    # Zipped, so that the text is split once and not once for each match.
    return F.when(n > 0, F.arrays_zip(matches, F.slice(pieces, 1, n), F.slice(pieces, 2, n)))


def _matches(body: Column, kind: str) -> Column:
    sign = {"email": "@", "phone": "+", "ip": "."}.get(kind)
    found = _pieces(body, FORMS[kind], F.contains(body, F.lit(sign)) if sign else F.lit(True), F.length)
    return F.transform(found, lambda x: F.struct(x["1"].alias("gap"), F.length(x["0"]).alias("len"), _valid(kind, x["0"]).alias("ok")))


def _kind_of(value: Column) -> Column:
    """The kind a whole value has by its form, empty if it only holds one, null if it holds none."""
    whole, held = F.lit(None).cast("string"), F.lit(False)
    for kind in KINDS:
        whole = F.when(F.regexp_like(value, F.lit(f"^(?:{FORMS[kind]})$")) & _valid(kind, value), F.lit(kind)).otherwise(whole)
        held = held | F.exists(F.regexp_extract_all(value, F.lit(FORMS[kind]), F.lit(0)), _check(kind))
    return F.coalesce(whole, F.when(held, F.lit("")))


def _candidates(body: Column) -> Column:
    """Runs of words with a digit or at-sign: place, value and the words around them."""
    blanks = " \t\n\x0b\f\r"

    def around(piece: Column) -> Column:
        words = F.split(F.lower(F.btrim(piece, F.lit(blanks))), r"\s+")
        return F.struct(
            F.length(piece).alias("gap"), F.get(words, F.size(words) - 2).alias("l2"), F.get(words, F.size(words) - 1).alias("l1"), F.get(words, F.lit(0)).alias("r1")
        )

    def entry(found: Column) -> Column:
        run, before, after = found["0"], found["1"], found["2"]
        tail = F.regexp_replace(run, _LEAD, "")
        value = F.regexp_replace(tail, _TRAIL, "")
        return F.struct(
            before["gap"].alias("gap"), F.length(run).alias("len"), (F.length(run) - F.length(tail)).alias("lead"), F.length(value).alias("n"),
            F.when(F.length(value).between(1, LONGEST), F.lower(F.regexp_replace(value, r"\s", " "))).alias("value"),
            F.when(F.length(value).between(1, LONGEST), _kind_of(value)).alias("kind"),
            F.coalesce(before["l2"], F.lit("")).alias("l2"), before["l1"].alias("l1"), after["r1"].alias("r1"),
        )

    return F.transform(_pieces(body, _RUN, body.rlike("[0-9@]"), around), entry)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One written row for each document with its matches of each form and its candidates.

    Each entry holds the length of the text before it, back to the entry before.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        *[_matches(body, kind).alias(kind) for kind in KINDS],
        _candidates(body).alias("runs"),
    )
    return stage(found, "pii-scan")


def _starts(rows: DataFrame) -> DataFrame:
    """``start`` of each entry: a document's entries of one kind summed up in order."""
    order = Window.partitionBy("row", "no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("start", F.sum(F.col("x.gap") + F.col("x.len")).over(order) - F.col("x.len"))


def base_spans(scanned: DataFrame) -> DataFrame:
    """(row, no, start, end) of the identifiers found by their form; ``no`` is the place in KINDS."""
    entries = [scanned.select("row", F.lit(no).alias("no"), F.posexplode(kind).alias("i", "x")) for no, kind in enumerate(KINDS)]
    rows = entries[0].union(entries[1]).union(entries[2]).union(entries[3])
    return _starts(rows).filter("x.ok").select("row", "no", "start", (F.col("start") + F.col("x.len")).alias("end"))


def graph(scanned: DataFrame) -> DataFrame:
    """(pattern, value, kind): which instance stands in which pattern, each pair once.

    ``kind`` is the seed's, null for an instance that no form covers. Values that only hold an
    identifier among other things take no part.
    """
    runs = scanned.select(F.explode("runs").alias("x")).select("x.*").filter("value is not null and (kind is null or kind <> '')")
    left, right = F.when(F.col("l1") == "", F.lit("^")).otherwise(F.col("l1")), F.when(F.col("r1") == "", F.lit("$")).otherwise(F.col("r1"))
    patterns = F.array(
        F.concat(left, F.lit(" _")),
        F.concat(F.col("l2"), F.lit(" "), left, F.lit(" _")),
        F.concat(left, F.lit(" _ "), right),
    )
    return runs.select(F.explode(patterns).alias("pattern"), "value", "kind").groupBy("pattern", "value").agg(F.max("kind").alias("kind"))


def bootstrap(edges: DataFrame, trust: float = TRUST, support: int = SUPPORT, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind, score) of the instances that trusted patterns discover.

    A pattern's trust in a kind is the sum of its instances' scores for it, seeds counting 1,
    over the number of its instances plus one; an instance gets the largest trust of a pattern
    that reaches ``trust``. Rounds end early when they discover nothing more. A pattern or a
    value that holds a third of all edges is summed on the map side and looked up in a bounded
    broadcast, see ``left_lookup``.
    """
    edges = stage(edges, "pii-edges")
    sizes, uses = key_counts(edges, ["pattern"]), key_counts(edges, ["value"])
    hot_patterns, hot_values = hot_keys(sizes, ["pattern"]), hot_keys(uses, ["value"])
    seeds = edges.filter("kind is not null").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    open_edges = edges.filter("kind is null").select("pattern", "value")
    found, known = edges.sparkSession.createDataFrame([], seeds.schema), 0
    for _ in range(rounds):
        scores = seeds.union(found)
        scored = left_lookup(edges.select("pattern", "value"), scores, {"value": "value"}, "pattern", hot_values)
        sums = scored.filter("kind is not null").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
        trusted = (
            sums.join(sizes, "pattern")
            .withColumn("score", F.col("sum") / (F.col("_rows") + 1))
            .filter((F.col("score") >= trust) & (F.col("sum") >= support - 1e-9))
            .select("pattern", "kind", "score")
        )
        reached = left_lookup(open_edges, stage(trusted, "pii-patterns"), {"pattern": "pattern"}, "value", hot_patterns).filter("score is not null")
        best = reached.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best"))
        found = stage(best.select("value", "best.kind", "best.score"), "pii-found")
        if (count := found.count()) == known:
            break
        known = count
    return found


def context_spans(scanned: DataFrame, found: DataFrame, base: DataFrame) -> DataFrame:
    """(row, no, start, end) of all places of discovered values that touch no base span."""
    rows = _starts(scanned.select("row", F.lit(0).alias("no"), F.posexplode("runs").alias("i", "x")))
    open_runs = rows.filter("x.value is not null and x.kind is null").select("row", "start", F.col("x.value").alias("value"), F.col("x.lead").alias("lead"), F.col("x.n").alias("n"))
    counts = key_counts(open_runs, ["value"])
    placed = left_lookup(open_runs, found.select("value", F.col("kind")), {"value": "value"}, "row", hot_keys(counts, ["value"])).filter("kind is not null")
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    spans = placed.select("row", number.alias("no"), (F.col("start") + F.col("lead")).alias("start"), (F.col("start") + F.col("lead") + F.col("n")).alias("end"), F.lit(True).alias("new"))
    touched = base.join(spans.select("row").distinct(), "row", "left_semi").withColumn("new", F.lit(False))
    both = spans.unionByName(touched)
    before = Window.partitionBy("row").orderBy("start", "new").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("new")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = (F.coalesce(F.col("_last"), F.lit(0)) <= F.col("start")) & (F.col("_next").isNull() | (F.col("_next") >= F.col("end")))
    marked = both.withColumns({"_last": F.max(F.when(~F.col("new"), F.col("end"))).over(before), "_next": F.min(F.when(~F.col("new"), F.col("start"))).over(after)})
    return marked.filter(F.col("new") & free).select("row", "no", "start", "end")


def _equals(no: int):
    return lambda x: x == no


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["no"]), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **graph_options) -> DataFrame:
    """(id_col, n_* and base_sha256 of the spans found by form, spans with those found by context, n_context)."""
    scanned = scan(docs, id_col, text)
    base = base_spans(scanned)
    added = context_spans(scanned, bootstrap(graph(scanned), **graph_options), base)
    everything = base.withColumn("new", F.lit(False)).unionByName(added.withColumn("new", F.lit(True)))
    lists = everything.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("no", "start", "end", "new"))).alias("all"))
    none = F.array().cast("array<struct<no:int,start:bigint,end:bigint,new:boolean>>")
    held = scanned.select("row", "id").join(lists, "row", "left").withColumn("all", F.coalesce("all", none))
    own = F.filter("all", lambda s: ~s["new"])
    return held.select(
        F.col("id").alias(id_col),
        *[F.size(F.filter(F.transform(own, lambda s: s["no"]), _equals(no))).cast("long").alias(f"n_{kind}") for no, kind in enumerate(KINDS)],
        F.sha2(_listed(own), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: s["new"])).cast("long").alias("n_context"),
    )


def op12_pii_bootstrap(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text.

    n_email to n_phone and base_sha256 cover the spans found by form, spans also those found by
    context, whose number is n_context. A null text is empty; a repeated or null id keeps each of
    its rows; an empty table gives no row; other columns are ignored. Texts may be of any length;
    what only its context shows has at most LONGEST code points.
    """
    return find_personal_data(docs)
