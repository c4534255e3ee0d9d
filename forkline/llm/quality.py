"""Line-first quality rules, in Spark expressions only.

Each line is judged by three rules; failing lines go, and a document that keeps too little of its
text is rejected, as is one that fails the base rule on its size and its repetition.

Cases: a null or blank text has no words and is rejected with zeros everywhere; texts of any length
are read whole; repeated rows get the same result each; an empty table gives an empty result; other
columns of the input are not looked at, so their names cannot clash.
"""

from pyspark.sql import functions as F

# The phrases of page furniture, matched in lower case.
BOILERPLATE = ("all rights reserved", "privacy policy", "cookie policy", "terms of use", "terms of service",
               "enable javascript", "click here", "subscribe to our newsletter", "sign up for our newsletter",
               "lorem ipsum", "powered by wordpress", "skip to content", "share on facebook", "share on twitter")
SYMBOLS = "#*$%&|<>"
SEPARATORS = "[|>»•·]"
ENDS = r"[.!?…:;,。！？][\"'”’»)\]]*[\x20\x09-\x0D]*\z"
SPACE = r"[\x20\x09-\x0D]+"


def _words(line):
    return F.array_remove(F.split(line, SPACE), "")


def _symbols(line):
    return F.regexp_count(line, F.lit(f"[{SYMBOLS}]"))


def line_fails(line, low, words, chars, symbols, short_line=10, symbol_share=0.1, separators=2):
    """True for a line that is no prose; `low` is it in lower case.

    punctuation: a line of fewer than `short_line` words without a closing mark, or any line in which
    symbols are more than `symbol_share` of its characters; navigation: `separators` or more menu
    separators among fewer than 3 * `short_line` words; boilerplate: a known phrase.
    """
    punctuation = (symbols > symbol_share * chars) | ((words < short_line) & ~line.rlike(ENDS))
    navigation = (words < 3 * short_line) & (F.regexp_count(line, F.lit(SEPARATORS)) >= separators)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    return punctuation | navigation | boilerplate


def _repeat_words(words):
    """Words inside 3-word windows that occur twice or more.

    Windows are sorted by a 64-bit hash; those with an equal neighbour repeat.  A text of a million
    words meets a false neighbour with probability 3e-8.
    """
    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.struct(
        F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.sort_array(windows)


def measure_lines(docs, doc_id="doc_id", text="text", least_words=50, repeat_percent=50, lost_share=0.5, **rules):
    """Per document: measures, verdicts and the text without failing lines.

    kept is false if the base rule fails or failing lines hold more than `lost_share` of the
    characters of its words.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # a line feed parts words as well, so the words of the lines are the words of the text
    d = d.select("doc_id", F.transform(F.split("t", "\n", -1), lambda x: F.struct(
        x.alias("line"), _words(x).alias("w"), F.lower(x).alias("low"), _symbols(x).alias("symbols"))).alias("l"))
    d = d.select("doc_id", F.flatten(F.transform("l", lambda x: x["w"])).alias("w"), F.transform("l", lambda x: F.struct(
        x["line"].alias("line"), x["low"].alias("low"), x["symbols"].alias("symbols"), F.size(x["w"]).alias("n"),
        F.aggregate(x["w"], F.lit(0), lambda a, y: a + F.char_length(y)).alias("chars"))).alias("l"))
    d = d.select("doc_id", "w", F.transform("l", lambda x: F.struct(
        x["line"].alias("line"), x["symbols"].alias("symbols"), x["chars"].alias("chars"),
        ((x["chars"] > 0) & line_fails(x["line"], x["low"], x["n"], x["chars"], x["symbols"], **rules)).alias("bad"))).alias("l"))
    total = lambda col, name: F.aggregate(col, F.lit(0), lambda a, x: a + x[name]).cast("long")
    d = d.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), total("l", "chars").alias("word_chars"),
        total("l", "symbols").alias("n_symbols"),
        F.transform(F.filter("l", lambda x: x["chars"] > 0), lambda x: x["line"]).alias("full"),
        F.filter("l", lambda x: ~x["bad"]).alias("good"), _repeat_words(F.col("w")).alias("s"))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    d = d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "good",
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        total("good", "chars").alias("kept_chars"),
        F.sort_array(F.transform(F.filter("s", lambda x, j: same(x, F.get(F.col("s"), j - 1))
                                          | same(x, F.get(F.col("s"), j + 1))), lambda x: x["i"])).alias("p"))
    gaps = F.transform("p", lambda x, j: F.least(F.coalesce(F.get(F.col("p"), j + 1) - x, F.lit(3)), F.lit(3)))
    d = d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "kept_chars", "good",
        F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "kept_chars",
        (~failed & (F.col("kept_chars") >= (1 - lost_share) * F.col("word_chars"))).alias("kept"),
        F.array_join(F.transform("good", lambda x: x["line"]), "\n").alias("clean_text"))


def clean(docs, text="text", n_chars="n_chars", **options):
    """The documents that pass, with their columns, without their failing lines."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(text).alias("text"))
    judged = measure_lines(packed, doc_id=row, text="text", **options)
    new = {text: F.col("clean_text")}
    if n_chars in docs.columns:
        new[n_chars] = F.char_length("clean_text").cast(docs.schema[n_chars].dataType)
    out = F.struct(*[new.get(c, F.col("doc_id")[c]).alias(c) for c in docs.columns])
    # a filter would be pushed below the measures and repeat them; a generator is not
    return judged.select(F.inline(F.when(F.col("kept"), F.array(out)).otherwise(F.slice(F.array(out), 1, 0))))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM p WHERE len(w) > 2)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY r),
l AS (SELECT r, unnest(ls) AS line FROM p),
m AS (SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
             length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS c,
             length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS s,
             length(regexp_replace(line, '[^|>»•·]', '', 'g')) AS seps FROM l),
v AS (SELECT r, line, c,
             (n < 10 AND NOT regexp_matches(regexp_replace(line, '[\x20\x09-\x0D]+$', ''),
                                            '[.!?…:;,。！？]["''”’»)\]]*$'))
             OR s > 0.1 * c OR (n < 30 AND seps >= 2)
             OR regexp_matches(lower(line), '{phrases}') AS bad FROM m),
k AS (SELECT r, coalesce(sum(CASE WHEN NOT bad THEN c END), 0) AS kept_chars,
             count(CASE WHEN c > 0 THEN 1 END) - count(DISTINCT CASE WHEN c > 0 THEN line END) AS n_dup FROM v GROUP BY r),
f AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_dup,
             coalesce(rep.n, 0) AS n_rep, kept_chars
      FROM p JOIN k USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup AS BIGINT) AS n_dup_lines,
       CAST(n_rep AS BIGINT) AS n_repeat_words, n_words < 50 OR 100 * n_rep > 50 * n_words AS base_failed,
       CAST(kept_chars AS BIGINT) AS kept_chars,
       NOT (n_words < 50 OR 100 * n_rep > 50 * n_words) AND kept_chars >= 0.5 * word_chars AS kept
FROM f""".replace("{phrases}", "|".join(BOILERPLATE))
