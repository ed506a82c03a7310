"""URL filter: rules first, then a trained classifier (DataFrame operations only).

A rule ``host/path`` fits its host and all hosts below it, where the url's path starts with
the rule's; of the rules that fit, the longest decides. Rules are grouped by host and joined
once for each number of labels their hosts have, on as many last labels of the url's host:
rows are neither multiplied nor shuffled while the rules can be broadcast.

A url without a rule is judged by logistic regression on hashed character n-grams of its
host and path. It is trained from a small table of labelled urls (``labelled_urls()`` or the
caller's; at most ``max_labelled`` different ones, in hash order) and scored as a sparse dot
product in each row.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salarium.llm.tables import LOWER, UPPER, column, configure
from salarium.plans.joins import bounded, hinted

NGRAMS = (3, 4, 5)
FEATURES = 1 << 15

# Words of the labelled addresses, common in addresses of unwanted pages and in
# those of ordinary ones; words that go with either; and what else an address is made of.
UNWANTED = """casino slots poker roulette jackpot gambling lottery bingo bets betting bookmaker blackjack baccarat win
    adult xxx porn sex nude erotic escort webcam strip fetish milf hentai
    viagra cialis pills pharmacy meds steroids weightloss payday loans cash bitcoin forex doubler
    replica rolex counterfeit warez crack keygen serial torrent pirate hack virus phishing
    spam farm backlinks traffic ads advert banner popup popunder clicks tracker track pixel prize giveaway""".split()
ORDINARY = """library news museum university school science physics mathematics chemistry biology geography history
    football cycling chess athletics travel trains maps hiking weather mountains rivers forest garden birds ocean
    photography music theatre literature poetry cinema painting architecture dance crafts
    health hospital nursing parliament government council court police embassy
    software databases programming documentation hardware networks statistics economics banking insurance
    recipes bakery cooking restaurant market bookshop furniture kitchen woodwork knitting
    then other there thing theory thread nation station motion north south earth mother father winter window
    family children village country people language translation dictionary support contact about""".split()
# the commonest letter pairs of English, for addresses made of no word at all
PAIRS = "th he in er an re on at en nd ti es or te ed is it al ar st to nt ng se ha as ou io le ve".split()
COMPANIONS = "best free my online live the top 24 world star home cheap real club zone shop".split()
PREFIXES, ENDINGS = ["", "www.", "m.", "blog."], ["com", "net", "org"]
PATHS = ["/en/101", "/de/88.html", "/", "/fr/52/", "/es/7", "/en/900/", "/index.html", "", "/fr/61", "/de/1240", "/en/33.html"]


def labelled_urls() -> list[tuple[str, int]]:
    """The default training table: four addresses for each word, alone and beside a companion;
    prefixes, endings and paths are dealt alike to both classes. Ordinary, too, are addresses
    made of letter pairs, and the empty url."""
    out = [("", 0)]
    made_up = [PAIRS[i % 30] + PAIRS[(7 * i + i // 30) % 30] + PAIRS[(11 * i + 5) % 30] for i in range(200)]
    for label, words in ((1, UNWANTED), (0, ORDINARY), (0, made_up)):
        for i, word in enumerate(words):
            a, b, c = (COMPANIONS[(i * 5 + j * 3) % len(COMPANIONS)] for j in range(3))
            for j, name in enumerate((word, f"{a}-{word}", f"{word}-{b}", f"{c}{word}")):
                place = f"{PREFIXES[(i + j) % len(PREFIXES)]}{name}.example.{ENDINGS[(i + 2 * j) % len(ENDINGS)]}"
                out.append((f"http://{place}{PATHS[(3 * i + j) % len(PATHS)]}", label))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; then up to ``?``, ``#`` or the end. Empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


# ---- rules -----------------------------------------------------------------------------


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``(rule, verdict)`` from pairs of a verdict and a text ``host/path``."""
    return spark.createDataFrame([(text, verdict) for verdict, text in rules], "rule string, verdict string")


def with_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages (key, url, host, path)`` with the longest rule that fits (null: none)."""
    rules = rules.where("rule IS NOT NULL").select(
        "rule", "verdict", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("rule_host"),
        F.regexp_extract("rule", "(?s)^[^/]*(.*)$", 1).alias("rule_path"))
    rules = rules.withColumn("labels", F.size(F.split("rule_host", r"\.", -1)))
    grouped, few = bounded(
        rules.groupBy("labels", "rule_host").agg(
            F.collect_set(F.struct(F.length("rule").alias("n"), "rule", "verdict", "rule_path")).alias("rules")))
    none = grouped.schema["rules"].dataType.simpleString()
    out = pages.withColumn("candidates", F.expr(f"CAST(array() AS {none})"))
    for row in grouped.select("labels").distinct().orderBy("labels").collect():  # how many labels a host can have
        at = hinted(grouped.where(F.col("labels") == row["labels"]).select("rule_host", "rules"), few)
        last = F.substring_index("host", ".", -row["labels"])
        out = out.join(at, last == F.col("rule_host"), "left").withColumn(
            "candidates", F.when(F.col("rules").isNull(), F.col("candidates")).otherwise(F.concat("candidates", "rules"))
        ).drop("rule_host", "rules")
    fitting = F.filter("candidates", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    return out.withColumn("best", F.array_max(fitting)).select(
        *pages.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


# ---- classifier ------------------------------------------------------------------------


def _grams(text: Column, mark: str) -> Column:
    """The text's character n-grams, marked at both ends; none for an empty text."""
    chars = F.split(F.concat(F.lit("^"), F.lower(text), F.lit("$")), "")

    def runs(c: Column, n: int) -> Column:
        return F.transform(c, lambda _, i: F.concat(F.lit(mark), *(F.get(c, i + j) for j in range(n))))

    # the outer array binds the characters to a variable, so they are split once and not for each n-gram
    grams = F.transform(F.array(chars), lambda c: F.array_compact(F.concat(*(runs(c, n) for n in NGRAMS))))[0]
    return F.when(text != "", grams).otherwise(F.array().cast("array<string>"))


def with_features(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) with a sparse vector of hashed n-grams, each counted once."""
    grams = urls.withColumn("grams", F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(grams).drop("grams")


def trained(labelled: DataFrame, max_labelled: int = 10_000) -> LogisticRegressionModel:
    """Logistic regression fitted to ``labelled (url, label)``; label 1 is to be blocked."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.select(host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label")).distinct()
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_labelled)
    data = with_features(rows).select("features", "label").coalesce(1)  # one order of summation: equal models in equal runs
    return LogisticRegression(regParam=0.0003, maxIter=100).fit(data)


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]] | DataFrame,
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
    url_col: str = "url",
    id_col: str = "page_id",
    max_labelled: int = 10_000,
) -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``rules``: pairs ("allow" or "block", "host/path"), or a table ``(rule, verdict)``; equally
    long rules that fit the same url are decided by the greater text. ``score`` is the
    classifier's probability that the url is to be blocked, given for every row; it decides
    where no rule fits.

    A null url, or one without ``://``, has an empty host and path: no rule fits it, it has no
    n-grams and gets the score of the intercept alone (below one half as trained here). Rows
    that repeat an id or a url each come back. Other columns, of whatever name, are not read.
    An empty table gives an empty result.
    """
    spark = pages.sparkSession
    configure(spark)
    if not isinstance(rules, DataFrame):
        rules = rule_table(spark, rules)
    if labelled is None:
        labelled = spark.createDataFrame(labelled_urls(), "url string, label int")
    model = trained(labelled, max_labelled)
    read = pages.select(column(pages, id_col).alias("key"), column(pages, url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    split = read.select("key", host.alias("host"), path.alias("path"))
    ruled = with_features(with_rule(split, rules))
    scored = model.transform(ruled).withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        F.col("key").alias(id_col), "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")


def allowed(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, labelled: DataFrame | None = None,
            threshold: float = 0.5, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` that are not blocked, with their columns."""
    configure(pages.sparkSession)
    whole = pages.select(F.struct(*(column(pages, c) for c in pages.columns)).alias("row"), column(pages, url_col).alias("url"))
    kept = judge(whole, rules, labelled, threshold, "url", "row").where("verdict = 'allow'")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in pages.columns))
