"""URL filters: host and path rules, then naive Bayes over segmented names.

Names in hosts and paths are split into words by a unigram Viterbi search. The unigram counts
come from the whole table: words of the pages' text and of hyphenated names. Words seen once
don't count in splitting.

A multinomial naive Bayes model scores the words. Its labels are ``examples``, a bounded list of labelled
names that the caller gives; the model is fitted on them, then refitted ``rounds`` times on all urls, each counted
in both classes by its odds so far (expectation maximisation). So a word that no example has counts by the company it
keeps, and an example's word that mostly stands in harmless names loses its weight. A word's odds are

    log((b + S * s) / s) - log((g + S * (1 - s)) / (1 - s))

with b and g its count in bad and good names, s the share of all words in bad names and S ``SMOOTHING``, so a
rare word leans to neither side by itself. Examples keep ``EXAMPLE_SHARE`` of all counts at any size of the table. Urls
are scored relationally: their distinct word lists, exploded, join the words' odds and are summed. A host is judged as one: the mean of its urls' odds
decides for all of them, so its pages agree, and a name that speaks in every url outweighs what stands in one path. Hosts are summed before they are joined.

What is broadcast has a proven bound: entries that make up at least one in ``VOCABULARY`` of a
total, so at most ``VOCABULARY`` of them, whatever the input's size, and the words of up to ``SHORT`` letters.
The other words are joined by a shuffle: to the distinct names, as their parts of the lengths that such words have,
and to the exploded word lists. Neither words nor names have a greatest length.

Null urls and urls without ``://`` have an empty host and path, match no rule and have no words;
the model's prior judges them. Repeated rows are judged alike.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import ChainMap, Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import ascii_lower, staged

VOCABULARY = 100_000
SHORT = 3
#: Cost of each letter of an unknown word, next to that of a word seen once.
LETTER_COST = 2.3
#: Parts of names that are written together.
PARTS_AT_ONCE = 50_000
SMOOTHING, EXAMPLE_SHARE, PRIOR = 1.0, 0.02, 0.1
#: Labelled names, as words; the label holds for all names behind it.
EXAMPLES = (
    ("block", "online casino bonus", "casino slots", "live casino jackpot", "casino bonus spins", "sport bets odds", "bets bonus", "lottery jackpot", "poker cash", "slots free spins"),
    ("block", "pills online", "viagra online", "payday cash loans", "weight loss pills", "diet pills shop", "replica watches cheap", "cheap tickets deals"),
    ("block", "adult", "adult movies", "adult video", "porn tube", "porn x video", "sex cams", "adult dating", "free porn", "xxx"),
    ("block", "ads", "click tracker", "ad server", "pop ads", "ads click", "pixel counter", "banner ads", "affiliate clicks"),
    ("block", "spam", "link spam", "seo links", "content mill", "buy links", "spam mail", "free download crack", "warez keys"),
    ("allow", "news", "daily news", "city library", "public library", "school", "university press", "science journal", "history museum", "art museum"),
    ("allow", "blog", "my blog", "garden blog", "cooking recipes", "travel guide", "book reviews", "music school", "film review", "poetry archive"),
    ("allow", "docs", "developer docs", "open source", "code forum", "user guide", "help center", "support forum", "wiki", "data archive"),
    ("allow", "home page", "company info", "our team", "about", "contact", "community forum", "weather report", "health service"),
    ("allow", "city council", "local government", "tax office", "railway timetable", "farm school", "family farm", "free school", "track and field", "sports club"),
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>"
LETTERS = re.compile(r"[a-z]+|[0-9]+")


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A to Z in lower case."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def matched_rule(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, like ``net/``, and its verdict; null where none fits.

    ``rules`` are (verdict, host and path); the first of equal length wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        own, _, rest = text.partition("/")
        fits = ((host_col == own) | host_col.endswith("." + own)) & path_col.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Splits a run of letters into the likeliest words.

    ``total`` is the sum of all counts, where ``counts`` lacks some.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = total or sum(counts.values()) or 1
        self.total = total
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.lengths = sorted({len(w) for w in self.cost}, reverse=True)
        self.unknown = math.log(total)
        self.known: dict[str, list[str]] = {}

    def split(self, name: str, more: dict[str, int] | None = None) -> list[str]:
        """``more`` are counts of words that the segmenter lacks."""
        cost_of, lengths = self.cost, self.lengths
        if more:
            cost_of = ChainMap({w: -math.log(n / self.total) for w, n in more.items()}, self.cost)
            lengths = sorted({*lengths, *map(len, more)}, reverse=True)
        # an unknown word costs more with each letter, so the best place for its start needs no search
        best, back, least, start = [0.0], [0], 0.0, 0
        for end in range(1, len(name) + 1):
            cost, at = self.unknown + LETTER_COST * end + least, start
            for k in lengths:
                own = cost_of.get(name[end - k : end]) if k <= end else None
                if own is not None and (c := best[end - k] + own) < cost:
                    cost, at = c, end - k
            best.append(cost), back.append(at)
            if cost - LETTER_COST * end < least:
                least, start = cost - LETTER_COST * end, end
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return words[::-1]

    def lacking(self, name: str, lengths: Sequence[int]) -> Iterator[str]:
        """Parts of the name, of the given lengths, that may be words that the segmenter lacks."""
        for k in lengths:
            for i in range(len(name) - k + 1):
                if (part := name[i : i + k]) not in self.cost:
                    yield part

    def words(self, text: str, special: dict[str, list[str]] | None = None) -> list[str]:
        """Words of the text's names; any number counts as ``0``. ``special`` has the words of some names."""
        special = special or {}
        if special or (found := self.known.get(text)) is None:
            found = []
            for x in LETTERS.findall(text):
                found += ["0"] if x.isdigit() else special[x] if x in special else self.split(x)
            if special:
                return found
            if len(self.known) >= 50_000:
                self.known.clear()
            self.known[text] = found
        return found


def unigrams(df: DataFrame, html: str, names: Column) -> DataFrame:
    """``w, n``: counts of the words of the pages, and of the parts of hyphenated and short names in their urls."""
    visible = F.lower(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), MARKUP, " "))
    # a name without a hyphen may be several words run together, so it is no evidence of a word unless it's short
    own = F.transform(F.split(names, "[^a-z-]+"), lambda x: F.when(x.contains("-") | (F.length(x) <= 3), F.split(x, "-")).otherwise(F.array()))
    pieces = F.concat(F.split(visible, "[^a-z]+"), F.flatten(own))
    words = df.select(F.explode(pieces).alias("w")).filter("w <> ''")
    return staged(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "url-words")


def _segmented(names: DataFrame, counts: DataFrame, lexicon: Sequence[str]) -> DataFrame:
    """``names`` (``host, path, count``) with their ``words``, by all words that occur twice or more."""
    spark = names.sparkSession
    sums = counts.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") >= 2, F.col("n"))).alias("twice")).first()
    least = max(2, (sums["all"] or 0) / VOCABULARY)
    common = (F.col("n") >= least) | ((F.length("w") <= SHORT) & (F.col("n") >= 2)) | F.col("w").isin(list(lexicon))
    own = {r["w"]: r["n"] for r in counts.filter(common).collect()}
    total = sums["twice"] or 0
    for word in lexicon:
        before = own.get(word, 0)
        own[word] = max(2, before)
        total += own[word] - (before if before >= 2 else 0)
    segmenter = spark.sparkContext.broadcast(Segmenter(own, total))
    special = F.lit(None).cast("array<struct<piece:string,own:array<string>>>")
    names = names.withColumn("special", special)
    if least > 2:
        rare = counts.filter(~common & (F.col("n") >= 2))
        # as many as there are lengths of words, which only grow with the square root of all letters
        lengths = sorted(r["k"] for r in rare.select(F.length("w").alias("k")).distinct().collect())

        def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(h, p, x) for h, p in zip(b["host"], b["path"], strict=True) for x in {*LETTERS.findall(h.rpartition(".")[0]), *LETTERS.findall(p.lower())} if len(x) > SHORT and not x.isdigit()]
                yield pd.DataFrame(rows, columns=["host", "path", "piece"])

        def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = ((k, w) for k, x in zip(b["name"], b["piece"], strict=True) for w in segmenter.value.lacking(x, lengths))
                while rows := list(itertools.islice(found, PARTS_AT_ONCE)):
                    yield pd.DataFrame(rows, columns=["name", "w"])

        def respelt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = [(x, segmenter.value.split(x, {m["w"]: m["n"] for m in more})) for x, more in zip(b["piece"], b["more"], strict=True)]
                yield pd.DataFrame([x for x in found if x[1] != segmenter.value.split(x[0])], columns=["piece", "own"])

        of = names.select("host", "path").mapInPandas(pieces, "host string, path string, piece string")
        # a long name goes by its digest, as it has many parts
        digest = F.concat(F.lit("#"), F.sha2("piece", 256))
        each = of.select("piece").distinct().select(F.when(F.length("piece") <= 64, F.col("piece")).otherwise(digest).alias("name"), "piece")
        known = each.mapInPandas(parts, "name string, w string").distinct().join(rare, "w")
        more = known.groupBy("name").agg(F.collect_list(F.struct("w", "n")).alias("more"))
        own_words = each.join(more, "name").select("piece", "more").mapInPandas(respelt, "piece string, own array<string>")
        by_name = of.join(own_words, "piece").groupBy("host", "path").agg(F.collect_list(F.struct("piece", "own")).alias("special"))
        names = names.drop("special").join(by_name, ["host", "path"], "left")

    def split_names(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths, specials in batches:
            out = []
            for h, p, x in zip(hosts, paths, specials, strict=True):
                own = {} if x is None else {y["piece"]: list(y["own"]) for y in x}
                # the last label of a host is no name
                out.append(segmenter.value.words(h.rpartition(".")[0], own) + segmenter.value.words(p.lower(), own))
            yield pd.Series(out, index=hosts.index, dtype=object)

    split_names.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    words = F.pandas_udf(split_names, "array<string>").asNondeterministic()
    return names.withColumn("words", words("host", "path", "special")).drop("special")


def word_odds(b: Column, g: Column, share: Column) -> Column:
    """Log odds of a word with ``b`` and ``g`` occurrences, where ``share`` of all words are in bad names."""
    return F.log((b + SMOOTHING * share) / share) - F.log((g + SMOOTHING * (1 - share)) / (1 - share))


def _totals(words: DataFrame) -> tuple[float, float]:
    sums = words.agg(F.sum("b").alias("b"), F.sum("g").alias("g")).first()
    return sums["b"] or 0.0, sums["g"] or 0.0


def _scored(terms: DataFrame, words: DataFrame, prior: float) -> DataFrame:
    """``key, odds`` for the exploded word lists ``terms`` (``key, w, m``) by the counts ``words`` (``w, b, g``)."""
    b, g = _totals(words)
    if not b or not g:
        return terms.select("key").distinct().withColumn("odds", F.lit(prior))
    model = words.select("w", (F.col("b") + F.col("g")).alias("n"), word_odds(F.col("b"), F.col("g"), F.lit(b / (b + g))).alias("o"))
    often = F.col("n") >= (b + g) / VOCABULARY
    hot = F.broadcast(model.filter(often).select("w", "o"))
    frequent = terms.join(hot, "w").select("key", (F.col("m") * F.col("o")).alias("o"))
    rest = terms.join(hot.select("w"), "w", "left_anti").join(model.filter(~often).select("w", "o"), "w").select("key", (F.col("m") * F.col("o")).alias("o"))
    known = frequent.unionByName(rest).groupBy("key").agg(F.round(F.sum("o") + prior, 9).alias("odds"))
    return terms.select("key").distinct().join(known, "key", "left").withColumn("odds", F.coalesce("odds", F.lit(prior)))


def judged_lists(lists: DataFrame, examples: Sequence[tuple[str, ...]] = EXAMPLES, rounds: int = 2) -> DataFrame:
    """``key, odds`` for the distinct word lists ``lists`` (``key, words, n``; ``n`` urls have the list), and the empty list."""
    spark = lists.sparkSession
    labelled = Counter((w, label) for label, *names in examples for name in names for w in name.split())
    given = [(w, float(labelled[w, "block"]), float(labelled[w, "allow"])) for w in sorted({w for w, _ in labelled})]
    given = spark.createDataFrame(given, "w string, b double, g double")
    terms = lists.select("key", "n", F.explode("words").alias("w")).groupBy("key", "n", "w").agg(F.count(F.lit(1)).alias("m"))
    terms = staged(terms, "url-terms")
    n_words = terms.agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    n_given = sum(labelled.values())
    weight = max(1.0, EXAMPLE_SHARE * n_words / max(1, n_given))
    words, prior = given, math.log(PRIOR / (1 - PRIOR))
    for _ in range(rounds):
        odds = staged(_scored(terms, words, prior), "url-odds")
        # (least and greatest pass over nulls)
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.coalesce("odds", F.lit(prior)), F.lit(30.0)), F.lit(-30.0))))
        share = lists.select("key", "n").join(odds, "key", "left").withColumn("p", p)
        bad, good = share.agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))).first()
        seen = terms.join(odds.select("key", p.alias("p")), "key").groupBy("w").agg(
            F.sum(F.col("n") * F.col("m") * F.col("p")).alias("b"), F.sum(F.col("n") * F.col("m") * (1 - F.col("p"))).alias("g")
        )
        both = seen.unionByName(given.select("w", (F.col("b") * weight).alias("b"), (F.col("g") * weight).alias("g")))
        words = staged(both.groupBy("w").agg(F.sum("b").alias("b"), F.sum("g").alias("g")), "url-model")
        prior = math.log(((bad or 0) + 1) / ((good or 0) + 1))
    odds = _scored(terms, words, prior)
    return lists.select("key").join(odds, "key", "left").withColumn("odds", F.coalesce("odds", F.lit(prior)))


def filter_urls(
    df: DataFrame,
    rules: Sequence[tuple[str, str]],
    url: str = "url",
    html: str = "html",
    examples: Sequence[tuple[str, ...]] = EXAMPLES,
    rounds: int = 2,
) -> DataFrame:
    """Adds ``host, path, rule, verdict, words, odds``; every row stays.

    ``verdict`` is the rule's, else ``block`` if the mean of the model's log odds over the host's urls is above 0, else
    ``allow``; ``odds`` are the url's own. ``examples`` are (label, name, ...) with names as words. Columns of the added names in ``df`` are replaced.
    """
    address = F.col(url).cast("string")
    counts = unigrams(df, html, F.concat(host(address), F.lower(path(address))))
    split = df.withColumn("host", host(address)).withColumn("path", path(address))
    names = staged(split.groupBy("host", "path").agg(F.count(F.lit(1)).alias("count")), "url-names")
    known = sorted({w for _, *own in examples for name in own for w in name.split()})
    names = staged(_segmented(names, counts, known).withColumn("key", F.array_join(F.array_sort("words"), " ")), "url-sets")
    lists = names.groupBy("key").agg(F.first(F.array_sort("words")).alias("words"), F.sum("count").alias("n"))
    odds = staged(judged_lists(staged(lists, "url-lists"), examples, rounds), "url-odds")
    judged = staged(names.join(odds, "key").select("host", "path", "count", "words", "odds"), "url-judged")
    hosts = judged.groupBy(F.col("host").alias("__of")).agg(F.try_divide(F.sum(F.col("count") * F.col("odds")), F.sum("count")).alias("__mean"))
    judged = judged.join(hosts, F.col("host") == F.col("__of")).select("__mean", F.col("host").alias("__host_of"), F.col("path").alias("__path_of"), "words", "odds")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    split = split.drop("words", "odds", "rule", "verdict").join(judged, (F.col("host") == F.col("__host_of")) & (F.col("path") == F.col("__path_of")), "left").drop("__host_of", "__path_of")
    return split.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, F.when(F.col("__mean") > 0, "block").otherwise("allow"))).drop("__mean")
