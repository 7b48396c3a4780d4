"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is

* a value that a name with a name of a secret in it is given (``:``, ``=``): in quotes, also words with
  blanks between, or up to the next white space; of any signs and at least 4 characters,
* the password of a url's ``user:password@``,
* what stands between quotes, without white space, of at least 4 characters,
* a run of at least 16 characters of the base64 and url-safe alphabets.

What fits several is taken as the first of them. Each is described by

* its length,
* transitions: how often neighbouring characters change between small, capital, digit and sign,
  the share of pairs that are common in words, the shares of digits and of other signs, blanks,
  the entropy of its characters,
* whether it begins like a key of a known kind,
* whether it refers to something (a variable, call or gap), or its name only begins like a secret's,
* dictionary coverage: the share of it that known words and placeholder words make up,
* path: whether it or its surroundings read like a path, url or file name,
* neighbouring words: whether the text right before assigns it to a name of a secret, or names
  something harmless (a checksum, commit, version or id), or quotes it.

A random forest learns from labelled findings which are secrets (``train``); ``scan`` keeps the
candidates with a high enough score. ``findings`` makes a stated set of labelled findings of the
usual kinds for those who have none of their own.

Only DataFrame functions and Spark's own forest are used. Scanning is one narrow stage: candidates
are put between two marks, and the text is cut at the marks, so that what stands before and behind
each is at hand. The marks are noncharacters of Unicode; a text that has them has blanks there.

Null and empty texts have no candidates. Long texts and candidates are taken whole; 40 characters
before and 24 behind a candidate are its surroundings. Repeated rows give repeated findings, a
null key gives findings with a null key.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm._common import settled
from headway.session import run_dir

LETTERS = "A-Za-z0-9+/_="
BEFORE, BEHIND = 40, 24
#: Words by which people name secrets, harmless long values, and placeholders; and pairs of letters that words are made of.
SECRET_NAMES = "token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer"
#: What keys of known kinds begin with.
KEY_PREFIXES = "A[KS]IA[A-Z2-7]{12}|gh[pousr]_|github_pat_|sk_(?:live|test)_|xox[abprs]-|glpat-|AIza|eyJ[A-Za-z0-9]"
#: Candidates: pairs of groups, what leads to a value and the value.
GIVEN = rf"(?<![\w-])(?=[\w-]++[\"'`\])]{{0,2}}\s*+[:=])(?=[\w-]*?(?=[a-cpstA-CPST])(?i:{SECRET_NAMES}))[\w-]++[\"'`\])]{{0,2}}\s*+(?::=|=>|[:=])\s*+"
PHRASE = r"\w++(?: \w++)++"
UNQUOTED = r"[^\s\"'`][^\s\"`]{2,}[^\s\"'`,;.)\]}>]"
CANDIDATE = "|".join((
    rf"({GIVEN}\")([^\s\"]{{4,}}|{PHRASE})(?=\")",
    rf"({GIVEN}')([^\s']{{4,}}|{PHRASE})(?=')",
    rf"({GIVEN}`)([^\s`]{{4,}}|{PHRASE})(?=`)",
    rf"({GIVEN}[\"'`]?)({UNQUOTED})",
    r"(://[^\s/:@\"'<>]*+:)([^\s/@\"<>]{4,})(?=@)",
    rf"((?<!\w)[\"'`])(?![^\s\"'`]*?{GIVEN}[\"'`]?[^\s\"'`]{{4}})(?![a-zA-Z]++://[^\s/:@]*+:[^\s/@]{{4,}}@)([^\s\"'`]{{4,}})(?=[\"'`](?!\w))",
    rf"()(?<![{LETTERS}-])(?=[{LETTERS}-]{{16}})(?=[+/_=-]*[A-Za-z0-9])(?![{LETTERS}-]*?{GIVEN}[\"'`]?[^\s\"'`]{{4}})([{LETTERS}-]{{16,}})",
))
OPENS, CLOSES = "\ufdd0", "\ufdd1"
HARMLESS_NAMES = "commit|sha-?[0-9]*|md5|checksum|digest|hash|etag|uuid|guid|version|revision|integrity|id|ref|build|image"
WORDS = (
    "example|sample|dummy|placeholder|change|your|here|test|demo|fake|secret|token|password|user|admin|key|value|name|file|index|static|"
    "assets|images|content|upload|download|article|page|news|http|https|www|com|org|net|html|json|version|release|data|the|and|for|with|required|optional|none|null|true|false|string|hidden|enabled|unknown|get|set|config|environ|process|env|x{4,}|0{4,}|1234567890|abcdef")
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce"
FEATURES = ("length", "changes", "pairs", "digits", "entropy", "covered", "path", "assigned", "named", "harmless", "quoted", "signs", "blanks", "refers", "author", "prefixed")
#: The forest, and the score from which on a candidate is a finding.
TREES, DEPTH, LEAST_SCORE = 30, 7, 0.5
#: Labelled findings that ``findings`` makes, at most.
FINDINGS = 4000


def _share(count: Column, of: Column) -> Column:
    return F.when(of > 0, count / of).otherwise(F.lit(0.0)).cast("double")


def described(df: DataFrame) -> DataFrame:
    """Adds the features of candidates: ``value``, ``before`` and ``behind``, texts."""
    value, length = F.col("value"), F.length("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"[a-z]+", "a"), r"[A-Z]+", "B"), r"[0-9]+", "1"), r"[^aB1]+", "-")
    letters = F.lower(F.regexp_replace(value, r"[^A-Za-z]", ""))
    characters = F.filter(F.split(value, ""), lambda c: c != "")
    counts = F.transform(F.array_distinct(characters), lambda c: (length - F.length(F.replace(value, c, F.lit("")))) / length)
    entropy = F.aggregate(counts, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    before = F.lower(F.col("before"))
    return df.withColumns({
        "length": length.cast("double"),
        "changes": _share(F.length(kinds) - 1, length),
        "pairs": _share(F.regexp_count(letters, F.lit(f"(?=(?:{PAIRS}))")), F.length(letters)),
        "digits": _share(F.regexp_count(value, F.lit("[0-9]")), length),
        "entropy": entropy,
        "covered": 1 - _share(F.length(F.regexp_replace(F.lower(value), f"(?:{WORDS})", "")), length),
        "path": (_share(F.regexp_count(value, F.lit("/")), length) + (F.col("before").rlike(r"[./\\]$") | F.col("behind").rlike(r"^\.[a-z]{2,4}\b")).cast("double")),
        "assigned": before.rlike(r"[:=]\s*[\"'`]?$").cast("double"),
        "named": before.rlike(rf"(?:{SECRET_NAMES})[\w\"' -]{{0,12}}\s*[:= ]?\s*[\"'`]?$").cast("double"),
        "harmless": before.rlike(rf"\b(?:{HARMLESS_NAMES})\s*[:= /-]?\s*[\"'`]?$").cast("double"),
        "signs": _share(F.regexp_count(value, F.lit(rf"[^{LETTERS}\s-]")), length),
        "blanks": F.regexp_count(value, F.lit(r"\s")).cast("double"),
        "prefixed": value.rlike(rf"^(?:{KEY_PREFIXES})").cast("double"),
        # A variable, call or gap to fill in, and a name that only begins like one of a secret.
        "refers": value.rlike(r"^[$<{\[%(]|^\*+$|[\w.]\(|\w\[|^(?:[A-Za-z_]+\.)+[A-Za-z_]+$|^[A-Za-z_][a-z]+_[a-z_]+$").cast("double"),
        "author": before.rlike(r"(?:auth(?:or|ori|ent)\w*|tokens|tokeni[sz]\w*|secretar\w*|passwords|credentials|keys)[\"']?\s*[:= ]\s*[\"'`]?$").cast("double"),
        "quoted": (F.col("before").rlike("[\"'`]$") & F.col("behind").rlike("^[\"'`]")).cast("double"),
    })


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, nth, value, before, behind): every candidate, numbered from 0 in its text."""
    body = F.translate(F.coalesce(F.col(text), F.lit("")), OPENS + CLOSES, "  ")
    groups = CANDIDATE.count("|(") + 1
    led, values = ("".join(f"${2 * i + k}" for i in range(groups)) for k in (1, 2))
    marked = F.regexp_replace(body, F.lit(CANDIDATE), F.lit(f"{led}{OPENS}{values}{CLOSES}"))
    cut = docs.select(F.col(key).alias("key"), F.split(marked, f"[{OPENS}{CLOSES}]", -1).alias("parts"))
    # Gaps and values take turns. An outer generator, since for an inner one the patterns would run once more as a filter.
    nth = F.when(F.size("parts") > 1, F.sequence(F.lit(0), F.floor((F.size("parts") - 3) / 2).cast("int"), F.lit(1)))
    each = cut.select("key", "parts", F.explode_outer(nth).alias("nth")).where(F.col("nth").isNotNull())
    value, before, behind = (F.col("parts")[2 * F.col("nth") + k] for k in (1, 0, 2))
    return each.select("key", "nth", value.alias("value"), F.right(before, F.lit(BEFORE)).alias("before"), F.left(behind, F.lit(BEHIND)).alias("behind"))


def findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """(value, before, behind, label): n labelled findings of usual kinds, half of them secrets."""
    seed = F.sha2(F.concat(F.lit("finding "), F.col("id").cast("string")), 512)
    base64 = F.regexp_replace(F.base64(F.unhex(seed)), r"=+$", "")
    at = F.pmod(F.xxhash64("id"), F.lit(97))
    size = (16 + F.pmod(F.xxhash64("id", F.lit("size")), F.lit(49))).cast("int")
    spelled = F.concat_ws("-", *[F.element_at(F.split(F.lit(WORDS.split("|x{4,}")[0]), r"\|"), (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(30)) + 1).cast("int")) for i in range(4)])
    uuid = F.concat_ws("-", F.substring(seed, 1, 8), F.substring(seed, 9, 4), F.substring(seed, 13, 4), F.substring(seed, 17, 4), F.substring(seed, 21, 12))
    # Words that nobody knows: of pairs of letters; and signs that passwords have.
    pairs, signs = F.array(*[F.lit(p) for p in PAIRS.split("|")]), F.array(*[F.lit(c) for c in "!@$#%.?&"])

    def word(n: int, length: int) -> Column:
        return F.concat(*[pairs[F.pmod(F.xxhash64("id", F.lit(f"word {n} {i}")), F.lit(40)).cast("int")] for i in range(length)])

    sign, few = signs[F.pmod(F.xxhash64("id", F.lit("sign")), F.lit(8)).cast("int")], (6 + F.pmod(F.xxhash64("id", F.lit("few")), F.lit(8))).cast("int")
    mixed = F.concat(F.left(base64, few - 2), sign, F.substring(base64, 20, 2))
    plain = F.concat(F.initcap(word(0, 2)), at.cast("string"), sign)
    bare = F.translate(F.upper(seed), "0123456789", "GHIJKLMNOP")
    fixed = F.array(*[F.lit(v) for v in "required optional none null true false string hidden enabled unknown changeme".split()])[F.pmod(at, F.lit(11)).cast("int")]
    # (label, value, before, behind)
    kinds = [
        (1, F.substring(seed, 1, 40), 'the config has token = "', '" and then'),
        (1, F.substring(seed, 1, 32), "export API_KEY=", " "),
        (1, F.left(base64, size), 'client_secret: "', '",'),
        (1, F.concat(F.lit("AKIA"), F.upper(F.substring(seed, 1, 16))), "aws access_key = ", "\n"),
        (1, F.concat(F.lit("ghp_"), F.left(F.regexp_replace(base64, "[+/]", "0"), F.lit(36))), "Authorization: Bearer ", "\n"),
        (1, F.left(base64, size), "password='", "'"),
        (1, F.concat(F.lit("sk_live_"), F.left(F.regexp_replace(base64, "[+/]", "0"), F.lit(24))), "auth token ", " in the log"),
        (1, plain, 'password = "', '"\n'),
        (1, F.concat(word(1, 3), (at % 10).cast("string")), "pwd=", "\n"),
        (1, mixed, "passwd: ", " and then"),
        (1, word(2, 6), "the password: '", "' works"),
        (1, F.concat_ws(" ", word(3, 2), word(4, 3), word(5, 2), word(6, 3)), 'secret: "', '"'),
        (1, mixed, "postgres://user:", "@db.local/x"),
        (1, F.concat(mixed, F.substring(base64, 30, 4)), 'connect("db", "', '")'),
        (1, F.concat(F.lit("AKIA"), F.left(bare, F.lit(16))), "aws key ", " in the log"),
        (1, F.concat(F.lit("AKIA"), F.left(bare, F.lit(16))), "aws_access_key_id=", "\n"),
        (1, F.left(F.regexp_replace(base64, "[0-9]", "x"), size), "api_key = ", "\n"),
        (0, F.substring(seed, 1, 40), "fixed by commit ", " on the branch"),
        (0, F.substring(seed, 1, 64), "sha256:", " of the image"),
        (0, uuid, 'the uuid "', '" of the record'),
        (0, F.concat(F.lit("assets/images/"), spelled, F.lit("/2021/05")), "see https://www.", ".html"),
        (0, F.concat(spelled, F.lit("-"), at.cast("string")), "read more at /news/", " or call"),
        (0, F.lpad(F.abs(F.xxhash64("id")).cast("string"), 19, "4"), "the number ", " was given"),
        (0, F.concat(F.lit("your_token_here_"), at.cast("string")), "token = ", "\n"),
        (0, F.concat(F.lit("xxxxxxxxxxxxxxxx"), at.cast("string")), "api_key: '", "'"),
        (0, F.left(base64, size), 'integrity="', '" crossorigin'),
        (0, fixed, "password: ", "\n"),
        (0, fixed, 'token = "', '"'),
        (0, F.initcap(word(7, 4)), "author: ", " wrote"),
        (0, at.cast("string"), "tokens: ", " in all"),
        (0, word(8, 3), 'the word "', '" is used'),
        (0, F.concat(word(9, 3), F.lit("-"), word(10, 3)), "called '", "' by"),
        (0, F.concat(word(11, 4), F.lit(".yaml")), 'open("', '")'),
        (0, F.concat(word(12, 5), word(13, 5)), "and ", " was"),
        (0, F.concat(F.lit("${"), F.upper(word(14, 3)), F.lit("}")), "password=", "\n"),
        (0, F.concat(F.lit("os.environ["), word(15, 3)), "token = ", "\n"),
        (0, F.concat(F.lit("get"), F.initcap(word(16, 4)), F.initcap(word(17, 4))), "calls ", "()"),
        (0, F.concat(F.lit("<your-"), word(18, 2), F.lit(">")), "api_key=", "\n"),
    ]
    secrets, harmless = [k for k in kinds if k[0]], [k for k in kinds if not k[0]]
    rows = [
        F.struct(F.lit(label).cast("double").alias("label"), value.alias("value"), F.lit(before).alias("before"), F.lit(behind).alias("behind"))
        for of in (secrets, harmless) for label, value, before, behind in of
    ]
    which = F.when(F.col("id") % 2 == 0, F.pmod(F.floor(F.col("id") / 2), F.lit(len(secrets))))
    which = which.otherwise(F.lit(len(secrets)) + F.pmod(F.floor(F.col("id") / 2), F.lit(len(harmless)))).cast("int")
    return spark.range(n).select(F.inline(F.array(F.array(*rows)[which]))).select("value", "before", "behind", "label")


def train(labelled: DataFrame) -> PipelineModel:
    """A forest from labelled findings: value, before, behind, label (1: a secret)."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, labelCol="label", featuresCol="features")
    # The features are computed once for all passes. A model as trained holds on to the session through its
    # summary, and cannot be sent to tasks where the session has listeners; one that is read has none.
    spark = labelled.sparkSession
    Pipeline(stages=[assembler, forest]).fit(settled(described(labelled))).save(path := run_dir(spark, "forest"))
    return PipelineModel.load(path)


def scan(docs: DataFrame, forest: PipelineModel, key: str = "doc_id", text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(key, nth, value, score): the candidates that the forest takes for secrets."""
    scored = forest.transform(described(candidates(docs, key, text)))
    score = vector_to_array("probability")[1]
    return scored.select(F.col("key").alias(key), "nth", "value", score.alias("score")).where(F.col("score") >= least)
