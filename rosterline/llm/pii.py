"""Personal data: patterns of four kinds, and contexts learnt from what they find.

Matches of the fixed patterns are the seeds. The words in front of a seed are a lexical pattern; the same words stand in
front of other identifiers, which no fixed pattern knows. Patterns and instances form a graph that is scored round by
round: a pattern is trusted once enough of its distinct instances are, an instance once a trusted pattern leads to
it. Occurrences of trusted instances behind trusted patterns are added spans, of kind `context`. Rounds work on counts,
the texts are read once. DataFrame functions only.

A pattern is the last two words in front of the word in which an instance begins (one where there is no second, none at
the start of a text), in lower case, of words over WORD_CHARS characters the last WORD_CHARS. An instance no fixed pattern
knows is a word with MIN_LENGTH characters and MIN_DIGITS digits or more, without the marks around it; shorter words
with digits are amounts, dates or numbers of parts too often to be told from identifiers by what stands in front of them.

Work and memory of a text grow with its length and its matches alone, however many matches one text holds. Places are
code points, ends exclusive; null texts count as empty."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, row_of, text_keys

KINDS = ["email", "ip", "card", "phone"]
ADDED = "context"

# The four kinds as given, written so that no scan of a long run starts anew at each of its characters: a match begins
# where a run begins or where the last match ended, and what can't be given back isn't tried again.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for the pattern to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}

IDENTIFIER = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"  # a word with a digit
WORD_CHARS = 64  # of a longer word in front, so many of its last characters count
_WORD = rf"(\s)\s*+(\S{{1,{WORD_CHARS}}}+)\S*+"
#: What a reversed text begins with: the start of the word it ends in, the words before that one, and a space before those.
LAST_WORDS = rf"(?s)^(\S{{0,{WORD_CHARS}}}+)\S*+(?:{_WORD}(?:{_WORD})?+)?+(\s?+).*"
CONTEXT = r"^\s*(\S+(?:\s\S+)?)\s\S*$"  # of such words, those in front
BLOCK = 256  # matches of a text that are added up together
MIN_DIGITS, MIN_LENGTH = 3, 5
MIN_SUPPORT, TRUST = 3, 80
FOUND = "struct<start:int,end:int,found:string,before:string>"


def _tail(c: Column) -> Column:
    """The last two words of a text and the beginning of a third, with the spaces between and in front cut to one."""
    return F.reverse(F.regexp_replace(F.reverse(c), LAST_WORDS, "$1$2$3$4$5$6"))


def _bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), where c is worked out once however often it is used."""
    return F.transform(F.array(c), use)[0]


def _blocks(items: Column) -> Column:
    """An array cut into arrays of BLOCK items, the last one of fewer or none. Appending to an array copies it, so long
    arrays are built block by block."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(items) / BLOCK).cast("int")),
                       lambda i: F.slice(items, i * BLOCK + 1, BLOCK))


def matches(text: Column, pattern: str, hint: str) -> Column:
    """Places, strings and the last words of the text before each of the leftmost non-overlapping matches. The pieces
    between matches give both: lengths are added up, and the text's last words are carried on."""
    between = F.split(text, pattern, -1)
    both = _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.zip_with(
        F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(
            F.char_length(b).alias("gap"), F.char_length(m).alias("len"), m.alias("found"), _tail(b).alias("before"))))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["len"]

        def more(before: Column) -> Column:
            one = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"), before.alias("before"))
            return F.struct(end.alias("at"), _tail(F.concat(before, x["found"])).alias("tail"),
                            F.concat(acc["out"], F.array(one)).alias("out"))

        return _bound(_tail(F.concat(acc["tail"], x["before"])), more)

    def add_block(acc: Column, block: Column) -> Column:
        zero = F.struct(acc["at"].alias("at"), acc["tail"].alias("tail"), F.array().cast(f"array<{FOUND}>").alias("out"))
        return F.aggregate(block, zero, add, lambda own: F.struct(
            own["at"].alias("at"), own["tail"].alias("tail"), F.concat(acc["out"], F.array(own["out"])).alias("out")))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(f"array<array<{FOUND}>>").alias("out"))
    every = _bound(both, lambda all_: F.aggregate(_blocks(all_), zero, add_block, lambda acc: F.flatten(acc["out"])))
    return F.when(text.rlike(hint), every).otherwise(F.array().cast(f"array<{FOUND}>"))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    turned = F.reverse(number)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), step) % 10 == 0


def _byte(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.char_length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\.", -1), _byte),
    "card": lambda m: F.char_length(digits(m)).between(16, 19) & luhn(digits(m)),
    "phone": lambda m: F.char_length(digits(m)).between(8, 15),
}


def base_spans(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, an array of (start, end) for each kind, `seeds`: the base spans with what they are and what
    stands in front, and `candidates`: the same of words with a digit. Where the text has no digit there is neither ip
    nor candidate, and so on."""
    filled = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    t = F.col("_t")

    def spans(kind: str) -> Column:
        return F.filter(matches(t, PATTERNS[kind], HINTS[kind]), lambda x: VALID[kind](x["found"]))

    whole = filled.select(*keep, "_t", *[spans(k).alias(k) for k in KINDS])
    bare = [F.transform(k, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(k) for k in KINDS]
    return whole.select(*keep, *bare, F.concat(*KINDS).alias("seeds"), matches(t, IDENTIFIER, "[0-9]").alias("candidates"))


def _pattern(before: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(before, CONTEXT, 1)), r"\s", " ")


def graph_candidates(rows: DataFrame, row: str, min_length: int = MIN_LENGTH, min_digits: int = MIN_DIGITS) -> DataFrame:
    """(row, start, end, pattern, instance, seed): the whole base spans (seed), but for those that begin within another,
    and identifiers that touch none, without the marks around them. A text's spans are sorted, and the furthest end of
    the base spans that begin before a place tells what reaches over it."""
    seeds = rows.select(row, F.explode("seeds").alias("s")).select(
        row, F.col("s.start").alias("at"), "s.start", "s.end", F.col("s.start").alias("_from"),
        _pattern(F.col("s.before")).alias("pattern"), F.col("s.found").alias("instance"), F.lit(True).alias("seed"))
    c = rows.select(row, F.explode("candidates").alias("c"))
    unmarked = F.regexp_replace("c.found", r"^[^\p{L}\p{N}+]+", "")
    bare = F.regexp_replace(unmarked, r"[^\p{L}\p{N}]++$", "")
    start = F.col("c.start") + F.char_length("c.found") - F.char_length(unmarked)
    others = c.select(
        row, F.col("c.end").alias("at"), start.alias("start"), (start + F.char_length(bare)).alias("end"),
        F.col("c.start").alias("_from"), _pattern(F.col("c.before")).alias("pattern"), bare.alias("instance"),
        F.lit(False).alias("seed")) \
        .filter((F.char_length("instance") >= min_length) & (F.char_length(digits(F.col("instance"))) >= min_digits)
                & (F.col("pattern") != ""))
    by_place = Window.partitionBy(row).orderBy("at")
    end = F.when(F.col("seed"), F.col("end"))
    before = F.max(end).over(by_place.rangeBetween(Window.unboundedPreceding, -1))
    beside = F.max(end).over(by_place.rangeBetween(0, 0))
    placed = seeds.union(others).withColumns({"_before": before, "_beside": beside})
    within = (F.coalesce("_before", F.lit(0)) > F.col("_from")) | (F.col("seed") & (F.col("_beside") > F.col("end")))
    return placed.filter(~within & (F.col("pattern") != "")).select(row, "start", "end", "pattern", "instance", "seed")


def trusted_pairs(found: DataFrame, support: int = MIN_SUPPORT, trust: int = TRUST) -> DataFrame:
    """(pattern, instance) of trusted patterns and the instances they lead to that aren't seeds. found has pattern,
    instance and seed. A pattern is trusted when at least `support`, and `trust` in 100, of its distinct instances are
    trusted; whole numbers only, so the result doesn't depend on the order of sums. Rounds go on until one
    finds nothing new, and each writes what is known by then."""
    edges = materialize(found.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    known = materialize(edges.groupBy("instance").agg(F.max("seed").alias("known")), "instances")
    while True:  # known only grows
        graph = edges.join(known, "instance")
        scores = graph.groupBy("pattern").agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("known"), 1)).alias("good"))
        trusted = materialize(scores.filter((F.col("good") >= support) & (100 * F.col("good") >= trust * F.col("n")))
                              .select("pattern"), "patterns")
        led = edges.join(trusted, "pattern", "left_semi").select("instance").distinct().withColumn("led", F.lit(True))
        after = materialize(known.join(led, "instance", "left").select(
            "instance", (F.col("known") | F.coalesce("led", F.lit(False))).alias("known"),
            (~F.col("known") & F.coalesce("led", F.lit(False))).alias("new")), "instances")
        if not after.filter("new").limit(1).count():
            break
        known = after.select("instance", "known")
    return edges.filter("NOT seed").join(trusted, "pattern", "left_semi").select("pattern", "instance")


def all_spans(rows: DataFrame, row: str) -> DataFrame:
    """rows, a written table of base_spans() with a unique column row, and `added`: the spans learnt from contexts."""
    found = materialize(graph_candidates(rows, row), "candidates")
    pairs = materialize(trusted_pairs(found), "trusted")
    hits = found.filter("NOT seed").join(pairs, ["pattern", "instance"], "left_semi")
    added = hits.groupBy(row).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_a"))
    return rows.join(added, row, "left").withColumn(
        "added", F.coalesce("_a", F.array().cast("array<struct<start:int,end:int>>"))).drop("_a", "seeds", "candidates")


def listed(kinds: list[str]) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.concat_ws(",", *[_texts(k, k if k in KINDS else ADDED) for k in kinds])


def _texts(column: str, name: str) -> Column:
    return F.transform(column, lambda s: F.concat_ws(":", F.lit(name), s["start"], s["end"]))


def private_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, the number of base spans of each kind, base_sha256 and spans."""
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                        F.monotonically_increasing_id().alias("_row"))
    rows = materialize(base_spans(named, ["doc_id", "_row"]), "spans")
    return all_spans(rows, "_row").select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(KINDS), 256).alias("base_sha256"), listed([*KINDS, "added"]).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; spans that overlap are one, named by the first.
    spans: array of (start, end, kind) by start. The text is cut into the parts that blocks of spans reach to, and a span is
    looked up in its part."""
    def in_part(part: Column, first: Column) -> Callable[[Column, Column], Column]:
        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(part, acc["at"] - first + 1, s["start"] - acc["at"])
            more = F.array(gap, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                            F.when(s["start"] >= acc["at"], F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))
        return step

    def add_block(acc: Column, block: Column) -> Column:
        upto = F.greatest(acc["at"], F.coalesce(F.array_max(F.transform(block, lambda s: s["end"])), F.lit(0)))

        def cut(end: Column) -> Column:
            zero = F.struct(acc["at"].alias("at"), F.array().cast("array<string>").alias("out"))
            return _bound(F.substring(acc["rest"], F.lit(1), end - acc["at"]), lambda part: F.aggregate(
                block, zero, in_part(part, acc["at"]), lambda own: F.struct(
                    end.alias("at"), F.substring(acc["rest"], end - acc["at"] + 1, F.char_length(acc["rest"])).alias("rest"),
                    F.concat(acc["out"], F.array(F.array_join(own["out"], ""))).alias("out"))))
        return _bound(upto, cut)

    zero = F.struct(F.lit(0).alias("at"), text.alias("rest"), F.array().cast("array<string>").alias("out"))
    return _bound(spans, lambda all_: F.aggregate(_blocks(all_), zero, add_block, lambda acc: F.concat(
        F.array_join(acc["out"], ""), acc["rest"])))


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with all spans redacted in the text column, and the length column, if there is one, counted anew. Equal
    texts have equal spans but for what contexts add, which follow the text too, so spans are joined by text."""
    named = docs.select(F.col(f"`{text}`").alias("text")).select(*text_keys("text"), "text")
    rows = materialize(base_spans(named, ["_k1", "_k2"]).withColumn("_row", F.monotonically_increasing_id()), "spans")
    kinds = [F.transform(k, _with_kind(k if k in KINDS else ADDED)) for k in [*KINDS, "added"]]
    spans = all_spans(rows, "_row").select("_k1", "_k2", F.sort_array(F.concat(*kinds)).alias("_spans")) \
        .filter(F.size("_spans") > 0)
    spans = materialize(spans.groupBy("_k1", "_k2").agg(F.first("_spans").alias("_spans")), "redactions")
    keyed = docs.select(row_of(docs), *text_keys(f"`{text}`"), F.col(f"`{text}`").alias("_text")) \
        .join(spans.hint("merge"), ["_k1", "_k2"], "left")  # by shuffle at any size, as spans grow with docs
    hit = F.col("_spans").isNotNull()
    clean = keyed.withColumn("_text", F.when(hit, redacted(F.col("_text"), F.col("_spans"))).otherwise(F.col("_text")))
    column = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    column[text] = F.col("_text")
    if length in column:
        column[length] = F.when(hit, F.char_length("_text").cast(docs.schema[length].dataType)).otherwise(column[length])
    return clean.select(*[c.alias(name) for name, c in column.items()])


def _with_kind(name: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(name).alias("kind"))
