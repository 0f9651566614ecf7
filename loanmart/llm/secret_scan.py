"""Secrets in documents: random forest on candidates, in DataFrame expressions only.

Method: high-recall patterns propose candidates: key formats wherever they stand between other letters and digits, also
in a path or a joined name; in the rest of the text every value after a secret's name, whatever its length and characters
(in quotes up to the closing quote, else up to a blank, quote or one of ``,;&<>``, without closing punctuation), and every
long token with a digit. Labelled findings train a random forest that takes out false positives; its features are binned
length, character transitions, kind of characters, dictionary coverage, path and what follows. The dictionary is the
corpus' own: words that stand alone in ``LEAST_DOCS`` documents, not behind a colon or an equals sign, counted over all.
The forest is fitted on counts by feature combination over all labelled findings, its threshold is calibrated on findings
outside the fit to ``PRECISION``, and scoring is one Column.

Findings may be given (``doc_id``, ``s``, ``e``, ``label``). Without them the corpus labels itself: known key formats, and
values of a secret's name that are not made of dictionary words, are 1; values of any other name ("title: ..."), plain
numbers, dates and tokens of dictionary words are 0; the rest is not learned from, but scored. The name before a value makes
its label, so it is no feature: the forest learns what secrets look like, and a word behind a secret's name
("password: required") is judged by its looks.

Defined cases: a null or empty text has no candidates. Every row gets its row, rows that repeat an id or text too; a
null id stays null, a null path is an unknown path. Without labelled findings of both kinds nothing is a secret but what
a fixed format names. Other columns are not read. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.spans import banded, blanked, flag, fold, found
from loanmart.llm.trees import calibrated, counted, evaluate, forest, forest_column
from loanmart.session import settled

PRECISION = 0.95
CONTEXT = 32

# The generator, key formats that are sure, names that a secret is assigned to, words of ordinary tokens.
KEYS = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
        r"|(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
        r"|sk_(?:live|test)_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-]))")
SECRET = r"(?:password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key|auth)[\"']? ?[:=]{1,2} ?[\"']?"
NAMES = SECRET + "$"
#: The first look back is the cheap one.
GENERATOR = (rf"(?<=[:=] ?[\"']?)(?<=(?i:{SECRET}))(?:(?<=[\"'])[^\"'\r\n]++(?=[\"'])"
             r"|[^\s\"'`<>,;&:=.!?)\]}](?:[^\s\"'`<>,;&]*[^\s\"'`<>,;&:.!?)\]}])?)"
             r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}")
FORMATS = (r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
           r"|^sk_(?:live|test)_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$|^-----BEGIN")
ORDINARY = r"^[0-9]+$|^[0-9]{4}-[0-9]{2}-[0-9]{2}[T0-9-]*$|^[+0-9-]+$"
#: A value of any name; what a dictionary word looks like; documents that such a word must be in.
VALUE = (r"(?<=[A-Za-z0-9_\"')\]] ?[:=] ?[\"']?)(?:(?<=[\"'])[^\"'\r\n]++(?=[\"'])"
         r"|[^\s\"'`<>,;&:=.!?)\]}/](?:[^\s\"'`<>,;&]*[^\s\"'`<>,;&:.!?)\]}])?)")
WORD, LEAST_DOCS = r"(?<![^\s\"'(])(?<![:=])(?<![:=][\s\"'(])[a-z]{3,}+(?![^\s.,;:!?\"')])", 5
#: Every text with a key format holds one of these.
HINT = "AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_(?:live|test)_|AIza|PRIVATE KEY"
BINS = {"length": 11, "turns": 5, "signs": 6, "cover": 4, "path": 3, "follows": 3}


def _features(c: Column, path: Column) -> Column:
    v, before, after = c["v"], F.lower(c["before"]), c["after"]
    n = F.length(v)
    # one mark for each run of letters, digits or signs
    runs = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[A-Z]+", "A"), "[a-z]+", "a"), "[0-9]+", "0"), "[^A-Za-z0-9]+", "-"))
    words = F.filter(F.split(F.lower(v), "[^a-z]+"), lambda w: F.length(w) >= 3)
    signs = F.when(v.rlike("^[0-9]+$"), 0).when(v.rlike("^[A-Za-z]+$"), 5).when(v.rlike("^[0-9a-f]+$"), 1).when(v.rlike("^[0-9A-Z]+$"), 2).when(v.rlike("^[A-Za-z0-9]+$"), 3).otherwise(4)
    return F.struct(
        c["s"].alias("s"), c["e"].alias("e"), n.alias("n"), words.alias("words"), v.rlike(FORMATS).alias("sure"), before.rlike(NAMES).alias("named"), v.rlike(ORDINARY).alias("ordinary"),
        banded(n, 4, 8, 11, 14, 16, 18, 20, 24, 32, 40).alias("length"), banded(runs * 10 / n, 1, 3, 5, 7).alias("turns"), signs.alias("signs"),
        F.when(path.isNull() | ~path.rlike("[./]"), 0).when(F.lower(path).rlike("test|example|sample|fixture|doc"), 1).otherwise(2).alias("path"),
        F.when(after.rlike("^ [A-Za-z]{2}"), 1).when(after.rlike("^[\"']"), 2).otherwise(0).alias("follows"))


def dictionary(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``word`` for each word of the corpus that stands in running text of ``least`` documents."""
    # bursts of A-Z have no lower case to look for
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word")


def _scanned(docs: DataFrame, path: str) -> DataFrame:
    """``row``, ``doc_id``, ``held`` and, in ``cands``, the candidates and the values of other names; one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    at = F.col(path).cast("string")
    hint = text.rlike(HINT)
    # known keys are blanked, so that what they are joined with is looked at by itself
    left = F.when(hint, blanked(text, KEYS)).otherwise(text)
    keyed = docs.select(F.col("doc_id").cast("long"), at.alias("at"), found(text, KEYS, hint, CONTEXT).alias("keys"), left.alias("left"))
    proposed = found(F.col("left"), GENERATOR, F.col("left").rlike("[0-9:=]"), CONTEXT)
    others = F.filter(found(F.col("left"), VALUE, F.col("left").rlike("[:=]"), CONTEXT), lambda c: ~F.lower(c["before"]).rlike(NAMES))
    spans = keyed.select("doc_id", "at", F.array_sort(F.concat("keys", proposed)).alias("spans"), others.alias("others"))

    def described(found_spans: str, other: bool) -> Column:
        return F.transform(found_spans, lambda x: _features(x, F.col("at")).withField("other", F.lit(other)))

    every = F.concat(described("spans", False), described("others", True))
    return settled(spans.select(F.monotonically_increasing_id().alias("row"), "doc_id", fold().alias("held"), every.alias("cands")), "secrets")


def _cases(rows: DataFrame, words: DataFrame) -> DataFrame:
    """A row for each candidate with ``cover`` (of its characters by dictionary words) and the corpus' own label."""
    each = rows.select("row", "doc_id", "held", F.posexplode("cands").alias("pos", "c")).select("row", "doc_id", "held", "pos", "c.*")
    said = each.select("row", "pos", F.explode("words").alias("word")).join(words, "word").groupBy("row", "pos").agg(F.sum(F.length("word")).alias("covered"))
    known = each.drop("words").join(said, ["row", "pos"], "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    made = F.col("covered") * 10 >= F.col("n") * 7  # of dictionary words, but for signs between them
    label = F.when(F.col("sure"), 1).when(F.col("other"), 0).when(F.col("named") & made, None).when(F.col("named"), 1).when(F.col("ordinary") | made, 0)
    cover = F.when(F.col("covered") == 0, 0).when(F.col("covered") * 2 < F.col("n"), 1).when(~made, 2).otherwise(3)
    return settled(known.select("row", "doc_id", "held", "pos", "s", "e", "sure", "other", "named", *[c for c in BINS if c != "cover"], cover.alias("cover"),
                                label.cast("int").alias("label")), "secret-cases")


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``doc_id`` and ``cands`` (places, features, label) of each row with candidates."""
    cases = _cases(_scanned(docs, path), dictionary(docs)).where("not other")
    one = F.struct("s", "e", "label", "sure", "named", *BINS)
    return cases.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(one)).alias("cands")).select("doc_id", "cands")


def secret_spans(docs: DataFrame, findings: DataFrame | None = None, precision: float = PRECISION, path: str = "source") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_candidates``, ``n_secrets``, ``spans`` (start:end in code points, end
    exclusive, by start, comma-joined), ``max_prob`` (0 without candidates)."""
    rows = _scanned(docs, path)
    every = _cases(rows, dictionary(docs))
    cases = every
    if findings is not None:
        own = findings.select(F.col("doc_id").alias("of"), F.col("s").alias("from"), F.col("e").alias("to"), F.col("label").cast("int").alias("given"))
        on = (F.col("doc_id") == F.col("of")) & (F.col("s") == F.col("from")) & (F.col("e") == F.col("to"))
        cases = every.where("not other").join(own, on).withColumn("label", F.col("given"))
    fitted, tested = (counted(cases.where("held" if h else "not held"), BINS) for h in (False, True))
    both = fitted.pos.sum() > 0 and fitted.neg.sum() > 0
    model = forest(fitted) if both else []
    limit = calibrated(sum(evaluate(t, tested.x) for t in model) / len(model), tested, precision) if model and len(tested.x) else 1.1
    prob = F.greatest(forest_column(model, [F.col(f) for f in BINS]), F.when(F.col("sure"), 1.0).otherwise(0.0))
    scored = every.where("not other").select("row", F.struct("s", "e", prob.alias("p"), "sure").alias("c"))
    facts = scored.groupBy("row").agg(F.array_sort(F.collect_list("c")).alias("c"))
    kept = F.filter("c", lambda c: (c["p"] >= limit) | c["sure"])
    zero = F.lit(0).cast("long")
    return rows.select("row", "doc_id").join(facts, "row", "left").select(
        "doc_id", F.coalesce(F.size("c").cast("long"), zero).alias("n_candidates"), F.coalesce(F.size(kept).cast("long"), zero).alias("n_secrets"),
        F.coalesce(F.array_join(F.transform(kept, lambda c: F.concat_ws(":", c["s"], c["e"])), ","), F.lit("")).alias("spans"),
        F.coalesce(F.array_max(F.transform("c", lambda c: c["p"])), F.lit(0.0)).alias("max_prob"))
