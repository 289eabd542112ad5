"""Secret scan: candidate strings, and a random forest that removes false positives.

A candidate is a run of at least 16 letters, digits and ``+ / _ -`` with a digit
in it or of capitals only, or a value of at least 8 characters that is assigned to a word such as
password, token or key, with or without white space around the ``=`` or ``:``.  All
matches of both kinds in a text are judged; what a longer secret holds is part of it.  Its features are the length, the shares of digits, upper
case letters, vowels and distinct characters, the transitions between character
classes, how much of it is covered by words of a dictionary, the path it was found
under, and the words before it.  A random forest learned from labelled findings
decides; its trees become one SQL expression, so that scanning runs inside
Spark's generated code.

Labelled findings are rows (value, before, path, label).  ``labelled_findings``
derives a bounded number of them from the corpus: digests of its texts, written
the way credentials are, are secrets; digests named as checksums or commits,
numbers, dates, paths and identifiers made of its words are none.  The dictionary
counts the words of all documents.

Everything here is DataFrame and SQL functions; the forest is trained by
``pyspark.ml``.

Defined results: null text and null path count as empty; every row is scanned on
its own, so repeated rows give repeated findings; null doc_id stays null; a table
without candidates, or an empty one, gives no findings.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgepole.llm.common import cut, free_name, written

LABEL_ROWS = 600
MIN_COUNT = 5
TREES = 24
DEPTH = 6
MASK = "[SECRET]"

# a run is looked at from its first character only, so a long one is read once or twice
_RUN = r"(?<![A-Za-z0-9+/_\-])(?:(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{16,}+={0,2}|[A-Z]{16,}+(?![A-Za-z0-9+/_\-]))"
_KEYWORD = r"(?i)(passw(or)?d|passphrase|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential|auth(orization)?|bearer)s?"
_NEUTRAL = r"(?i)(sha|md5|crc|hash|digest|checksum|commit|revision|etag|uuid|guid|isbn|version|build|https?:|href|src|file|path|date|phone|card|order|ref)"
# a character no text holds (a noncharacter of Unicode): it marks the ends of matches
_EDGE = "\uffff"
_NAME = _KEYWORD + r"[\"']?\s*+[=:]\s*+[\"']?"
# a value ends before the next assignment to such a word, or the next name of a query string
_VALUE = rf"(?:(?!&[A-Za-z0-9_.\-]++=|{_NAME})[^\s\"',;<>{_EDGE}]){{8,}}+"
_ASSIGNED = rf"({_NAME})({_VALUE})"
_ASSIGNED_VALUE = re.compile(_NAME.replace("(?i)", "")).groups + 2  # number of its group
# characters before a candidate in which the words before it are looked for
_CONTEXT = 400
# pieces that can lie in it: a match has 8 characters at least, and a piece follows each
_NEAR_PIECES = 2 * (_CONTEXT // 8 + 1)
# Prefixes by which providers mark their keys.
_PREFIX = r"^(AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_live_|rk_live_|AIza|eyJ|glpat-)"
_TEST_PATH = r"(?i)(^|[/_.\-])(tests?|examples?|samples?|fixtures?|docs?|vendor|lock)([/_.\-]|$)"


def _pieces(text: Column, kind: int, pattern: str, marked: str) -> Column:
    """The text cut at the ends of all matches, as an array of (kind, nth, piece); every
    second piece is a match.  ``marked`` is the replacement that sets the edges."""
    cut_up = F.split(F.regexp_replace(text, pattern, marked), _EDGE, -1)
    return F.transform(cut_up, lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("nth"), p.alias("piece")))


def findings(docs: DataFrame, path_col: str = "source") -> DataFrame:
    """Candidates: row, doc_id, text_key, path, start (code points), value, before, outer.

    All runs and all assigned values of a text, each occurrence a finding.  ``row`` numbers
    the rows of the input and ``text_key`` is a hash of the text; ``before`` is the three
    words before and the part of the candidate's own word that precedes it, of
    the ``_CONTEXT`` characters before it; ``outer`` is the start of the longer
    assigned value that holds the candidate, or else its own start.

    Texts with a candidate are cut into pieces; of a piece between matches only its length
    and its last characters are moved.  Starts are running sums of the lengths, so the work
    grows with the text, however many candidates it has.
    """
    # no candidate holds the edge character, so a blank in its place changes none
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _EDGE, " ")
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), text.alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    some = rows.filter(F.col("text").rlike(_RUN) | F.col("text").rlike(_ASSIGNED)).withColumn("row", F.monotonically_increasing_id())
    both = F.concat(_pieces(F.col("text"), 0, _ASSIGNED, f"$1{_EDGE}${_ASSIGNED_VALUE}{_EDGE}"), _pieces(F.col("text"), 1, _RUN, f"{_EDGE}$0{_EDGE}"))
    own = ["row", "doc_id", "text_key", "path"]
    hit = F.col("nth") % 2 == 1
    pieces = some.select(*own, F.explode(both).alias("p")).select(
        *own, "p.kind", "p.nth", F.length("p.piece").alias("n"), F.when(hit, F.col("p.piece")).alias("value"), F.right("p.piece", F.lit(_CONTEXT)).alias("tail")
    )
    order = Window.partitionBy("row", "kind").orderBy("nth")
    placed = pieces.withColumns(
        {
            "start": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"),
            "context": F.right(F.array_join(F.collect_list("tail").over(order.rowsBetween(-_NEAR_PIECES, -1)), ""), F.lit(_CONTEXT)),
        }
    ).filter(hit)
    # assigned values do not overlap: only the last one that starts before a run can hold it
    end = F.col("start") + F.col("n")
    until = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = placed.withColumn("holder", F.last(F.when(F.col("kind") == 0, F.struct("start", end.alias("end"))), True).over(until))
    inside = (F.col("kind") == 1) & F.coalesce(F.col("holder.end") >= end, F.lit(False))
    same = inside & (F.col("holder.start") == F.col("start")) & (F.col("holder.end") == end)
    before = F.regexp_extract("context", r"(?:\S++\s++){0,3}\S*+\z", 0)
    return held.filter(~same).select(*own, "start", "value", before.alias("before"), F.when(inside, F.col("holder.start")).otherwise(F.col("start")).alias("outer"))


def dictionary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """The words that the documents hold at least ``min_count`` times."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count).select("word")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", pattern, "")) / F.length("value")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with one column for each feature; ``words`` is the dictionary."""
    letters = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))
    runs = found.select("value").distinct().select("value", F.explode(letters).alias("word"))
    covered = runs.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    classes = F.length(F.regexp_replace("value", "[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x"))
    return found.join(covered, "value", "left").withColumns(
        {
            "f_length": F.least(F.length("value"), F.lit(200)).cast("double"),
            "f_digits": _share("[^0-9]"),
            "f_upper": _share("[^A-Z]"),
            "f_vowels": _share("(?i)[^aeiou]"),
            "f_marks": _share("[A-Za-z0-9]"),
            "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
            "f_transitions": (classes - 1) / F.length("value"),
            "f_prefix": _flag(F.col("value").rlike(_PREFIX)),
            "f_hex": _flag(F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$")),
            "f_dictionary": F.coalesce(F.col("covered"), F.lit(0)) / F.length("value"),
            "f_test_path": _flag(F.col("path").rlike(_TEST_PATH)),
            "f_secret_word": _flag(F.col("before").rlike(_KEYWORD)),
            "f_neutral_word": _flag(F.col("before").rlike(_NEUTRAL)),
            "f_names_value": _flag(F.col("before").rlike(_KEYWORD + r"[\"']?\s*[=:]?\s*[\"']?$")),
            "f_assigned": _flag(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        }
    ).drop("covered")


def labelled_findings(docs: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """(value, before, path, label): about ``rows`` documents, chosen by a hash, give 18 findings each."""
    n = docs.count()
    share = min(1.0, rows / n) if n else 1.0
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.select(text.alias("text")).filter(F.pmod(F.xxhash64("text", F.lit("label")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).distinct()
    word = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,12}"), F.lit(0))
    w = lambda i: F.coalesce(F.get(F.col("w"), F.lit(i)), F.lit("word"))
    base = some.select("text", word.alias("w"), F.sha2("text", 256).alias("h"), F.md5("text").alias("m"))
    base = base.withColumn("b", F.translate(F.base64(F.unhex(F.sha2(F.concat("h", "m"), 512))), "+/=", "x4Q"))
    number = F.lpad(F.conv(F.substring("h", 1, 12), 16, 10), 16, "7")
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), F.conv(F.substring("h", 1, 3), 16, 10).cast("int")), "yyyy-MM-dd")
    two = F.substring(number, 15, 2)
    cases = [
        (1, F.concat(F.lit("AKIA"), F.upper(F.substring("b", 1, 16))), w(0)),
        (1, F.concat(F.lit("AKIA"), F.translate(F.upper(F.substring("b", 30, 16)), "0123456789", "QWXZKJVBPG")), w(12)),
        (1, F.concat(F.lit("ghp_"), F.substring("b", 20, 36)), F.concat_ws(" ", w(1), w(2))),
        (1, F.substring("h", 1, 18), F.concat_ws(" ", w(3), F.lit("password="))),
        (1, F.substring("b", 30, 12), F.concat_ws(" ", w(3), F.lit("passwd:"))),
        (1, F.substring("h", 10, 40), F.concat_ws(" ", w(4), F.lit('token = "'))),
        (1, F.substring("b", 1, 40), F.concat_ws(" ", w(5), F.lit("secret_key: '"))),
        (1, F.substring("b", 40, 32), F.concat_ws(" ", w(5), F.lit("api_key ="))),
        (0, F.col("h"), F.concat_ws(" ", w(6), F.lit("sha256:"))),
        (0, F.substring("h", 1, 40), F.concat_ws(" ", F.lit("commit"))),
        (0, F.concat_ws("-", F.substring("m", 1, 8), F.substring("m", 9, 4), F.substring("m", 13, 4), F.substring("m", 17, 4), F.substring("m", 21, 12)), F.concat_ws(" ", w(7), F.lit("uuid ="))),
        (0, F.concat_ws("_", w(8), w(9), w(10), two), F.concat_ws(" ", w(11), F.lit("="))),
        (0, F.rpad(F.upper(F.concat(w(8), w(9), w(10), w(11))), 18, "THE"), F.concat_ws(" ", w(1), w(3))),
        (0, F.concat_ws("/", w(11), w(12), w(13), F.concat(w(14), F.lit("-"), two)), F.concat_ws(" ", w(15), w(16))),
        (0, number, F.concat_ws(" ", w(17), w(18))),
        (0, number, F.concat(F.lit('token = "'), F.substring("h", 5, 40), F.lit('"'))),
        (0, F.concat_ws("_", w(2), w(4), two), F.concat(F.lit("password="), F.substring("h", 7, 18))),
        (0, F.concat(day, F.lit("T"), F.substring(number, 3, 6)), F.concat_ws(" ", w(19), F.lit("date:"))),
    ]
    rows_ = F.array(*[F.struct(F.lit(float(label)).alias("label"), value.alias("value"), F.concat_ws(" ", before).alias("before")) for label, value, before in cases])
    return base.select(F.explode(rows_).alias("f"), F.get("w", F.lit(0)).alias("path")).select("f.label", "f.value", "f.before", F.coalesce("path", F.lit("")).alias("path"))


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def _tree_sql(lines: list[str], names: list[str]) -> str:
    """A printed decision tree as one SQL expression."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return line.split()[1]
    feature, at = _SPLIT.match(line).groups()
    low = _tree_sql(lines, names)
    lines.pop(0)  # Else
    return f"(CASE WHEN {names[int(feature)]} <= {float(at)!r}D THEN {low} ELSE {_tree_sql(lines, names)} END)"


def train(labelled: DataFrame, words: DataFrame, trees: int = TREES, depth: int = DEPTH) -> str | None:
    """A SQL expression for the share of trees that call a finding a secret; None without labels.

    The training rows are sorted into one partition, so that the same findings
    give the same forest however the corpus is partitioned; their number is
    bounded by the caller (``LABEL_ROWS``).
    """
    table = features(labelled, words)
    names = [c for c in table.columns if c.startswith("f_")]
    ready = cut(VectorAssembler(inputCols=names, outputCol="features").transform(table.orderBy("value", "before", "path").coalesce(1)).select("label", "features"))
    if ready.isEmpty():
        return None
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="onethird").fit(ready)
    parts = []
    for tree in model.trees:
        lines = [x for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        parts.append(_tree_sql(lines, names))
    return "(" + " + ".join(f"CAST({p} AS DOUBLE)" for p in parts) + f") / {len(parts)}"


def scan(docs: DataFrame, labelled: DataFrame | None = None, path_col: str = "source", min_count: int = MIN_COUNT) -> DataFrame:
    """One row per candidate: doc_id, text_key, start, length, value, votes (0 to 1), is_secret."""
    labelled = labelled_findings(docs) if labelled is None else labelled
    words = written(dictionary(docs, min_count), "dictionary")
    forest = train(labelled, words)
    found = cut(findings(docs, path_col))
    votes = F.lit(0.0) if forest is None else F.expr(forest)
    scored = features(found, words).withColumn("votes", votes).withColumn("is_secret", F.col("votes") >= 0.5)
    # of a secret and what it holds, the longer one is the finding; both are judged
    same = Window.partitionBy("row", "outer")
    scored = scored.withColumns({"longest": F.max(F.length("value")).over(same), "within": F.max_by("is_secret", F.length("value")).over(same)})
    scored = scored.filter(~F.col("within") | (F.length("value") == F.col("longest")))
    return scored.select("doc_id", "text_key", "start", F.length("value").alias("length"), "value", "votes", "is_secret")


def redact(docs: DataFrame, labelled: DataFrame | None = None, path_col: str = "source", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret's value replaced by ``mask``; other rows and columns as they are.

    A value found in a document is replaced wherever that document holds it.
    Longer values go first, so a secret within a longer one is gone with it.
    """
    doc, key, values = (free_name(docs, n) for n in ("secret_doc", "secret_key", "secret_values"))
    secrets = scan(docs, labelled, path_col).filter("is_secret")
    by_text = secrets.groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).agg(F.collect_set("value").alias(values))
    by_text = by_text.withColumn(values, F.array_sort(values, lambda a, b: F.length(b) - F.length(a)))
    clean = F.aggregate(values, F.col("text"), lambda t, v: F.replace(t, v, F.lit(mask)))
    same = (F.xxhash64(F.col("text").cast("string")) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc))
    joined = docs.join(by_text, same, "left")
    text = F.when(F.col(values).isNull(), F.col("text")).otherwise(clean)
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(values).isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return out.select(*docs.columns)
