"""Secret scans: candidates by pattern, and a random forest that removes false positives.

A candidate is a run of 16 or more key characters with a digit; a value of 8 or more characters that a word such as
password or token names; the password in the credentials of an address; or a block of a private key. The
forest looks at its length, its characters, the transitions between their kinds and between letters as dictionary words have them, how
much of it dictionary words cover, at path and address marks, and at the neighbouring words on both sides. It is trained here from labelled findings: a
table of (before, candidate, after, label), by default ``labelled_findings``, a bounded set made from the
shapes that keys, hashes, identifiers, paths and placeholders have. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points of context kept on each side of a candidate.
CONTEXT = 60
TREES, DEPTH, SEED = 24, 7, 7
#: Labelled findings that the default training table has.
FINDINGS = 4_000
THRESHOLD = 0.5

# Words that name a secret in front of its value.
NAMING = "password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret"
# A long look-behind is tried at every length, so a short one that few places pass stands before each.
#: A naming word and what stands between it and a value: a quote, blanks and one mark. Java's look-behind needs the bounds; three blanks are the most.
_NAMED = rf"(?<=(?i:{NAMING})[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}"
_RUN = r"(?<![A-Za-z0-9_+/.\-])(?=[A-Za-z_+/.\-]*+[0-9])[A-Za-z0-9_+/.\-]{15,}[A-Za-z0-9_+/](?:={1,2}(?![A-Za-z0-9]))?"
CANDIDATE = "|".join(
    (
        r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[^-]*+-----END (?:[A-Z]+ )*PRIVATE KEY-----",
        # user names of up to 64 characters
        r"(?<=:)(?<=://[^\s/:@]{1,64}:)[^\s/@]{3,}+(?=@)",
        rf"(?<=[\"'`]){_NAMED}[\"'`])[^\s\"'`]{{8,}}+(?=[\"'`])",
        _RUN,
        rf"(?<=[=:][ \t]{{0,3}}){_NAMED})[^\s\"'`,;<>()\[\]{{}}]{{8,}}+",
    )
)

#: What a text with a candidate has for certain, found at a fraction of the pattern's cost: (parts that it contains, a pattern in it) for each kind.
_SIGNS = (
    (("PRIVATE KEY-----",), None),
    (("://", "@"), None),
    (("",), r"[A-Za-z0-9_+/.\-]{16}"),
    (("",), r"[DEYTNdeytn][\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"'`]?[^\s\"'`]{8}"),
)
#: Candidates of a text whose places are added up in one array; the sums of such blocks are added up after.
PLACES = 1024

# Words and prefixes that tell secrets from other identifiers.
KEY_WORDS = "token|secret|passwd|password|pwd|apikey|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?|client[_-]?secret|signing[_-]?key"
HASH_WORDS = "sha|sha1|sha256|sha512|md5|checksum|digest|commit|revision|etag|integrity|uuid|guid|blob|tree|parent|fingerprint|build|version|id"
PLACEHOLDERS = "example|sample|dummy|changeme|placeholder|redacted|your|test|fake|xxxx|0000|1234567|abcdef|todo|insert"
PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk-|sk_live_|pk_live_|rk_live_|xox[abprs]-|AIza|eyJ|ya29\\.|SG\\.|npm_|hf_"
DICTIONARY = (
    "about account action address admin after align application array article asset backup before block board branch browser "
    "bucket build button cache call center change chapter check client close cloud cluster code color column command comment config "
    "content control copy core count create current daily data database date default delete deploy design detail develop device dialog "
    "digest direct display document domain download edit email enable engine error event example export feature field file filter "
    "final first folder font footer format forum frame from function gallery game general global group guide header health help "
    "history home host icon image import index info input install item java journal key label large layer layout library license "
    "light link list local login long main manager map master media member menu message meta method mobile model module month name "
    "network news node note number object office online open option order output package page panel part password path photo "
    "picture play plugin point policy post preview print private process product profile project public query read record reference "
    "release remote report request research resource response result review root route sample schema script search section secret "
    "secure select server service session setting share short simple site small source space stage start state static status step "
    "storage store story string style subject submit summary support system table target task team template test text theme thread "
    "time title token tool total track train tree type unit update upload user value version video view web week widget window with "
    "word work world year"
).split()


def _letter_pairs() -> str:
    """A pattern that matches where two letters begin that follow each other in some dictionary word."""
    after: dict[str, set[str]] = {}
    for word in DICTIONARY:
        for x, y in zip(word, word[1:], strict=False):
            after.setdefault(x, set()).add(y)
    return "(?=" + "|".join(f"{x}[{''.join(sorted(after[x]))}]" for x in sorted(after)) + ")"


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def features(before: Column, candidate: Column, after: Column) -> dict[str, Column]:
    n = F.char_length(candidate).cast("double")
    lower = F.lower(candidate)
    near = F.regexp_extract(F.lower(before), r"((?:[^\s=:]+[\s=:]+){0,3}[^\s=:]*[\s=:\"'`>({\[]*)$", 1)
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    return {
        "length": n,
        "digits": _share(_matches(candidate, "[0-9]"), n),
        "upper": _share(_matches(candidate, "[A-Z]"), n),
        "symbols": _share(_matches(candidate, r"[^A-Za-z0-9]"), n),
        "transitions": _share(_matches(candidate, "[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])"), n),
        "letter_pairs": _share(_matches(lower, _letter_pairs()), _matches(lower, "(?=[a-z][a-z])")),
        "block": F.when(candidate.startswith("-----BEGIN "), 1.0).otherwise(0.0),
        "credentials": F.when(before.rlike(r"://[^\s/:@]+:$") & after.startswith("@"), 1.0).otherwise(0.0),
        "variable": F.when(candidate.rlike(r"[$%{}<>()\[\]]|^[A-Z_]+$|^[a-z]+(?:[._][a-z]+)+$"), 1.0).otherwise(0.0),
        "distinct": _share(F.size(F.array_distinct(F.split(candidate, ""))).cast("double"), F.least(n, F.lit(36.0))),
        "runs": _share(_matches(lower, r"(.)\1\1+"), n),
        "hex": F.when(candidate.rlike("^(?:0x)?[0-9a-fA-F]+$"), 1.0).otherwise(0.0),
        "numeric": F.when(candidate.rlike(r"^[0-9.+/=_\-]+$"), 1.0).otherwise(0.0),
        "uuid": F.when(lower.rlike("[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"), 1.0).otherwise(0.0),
        "vowels": _share(_matches(lower, "[aeiou]"), n),
        "dictionary": _share(n - F.char_length(F.regexp_replace(lower, words, "")), n),
        "placeholder": _matches(lower, PLACEHOLDERS),
        "prefix": F.when(candidate.rlike(f"^(?:{PREFIXES})"), 1.0).otherwise(0.0),
        "path": _matches(candidate, "/") + F.when(before.rlike(r"[/\\~]$"), 1.0).otherwise(0.0),
        "file": F.when(lower.rlike(r"\.[a-z]{2,5}$") | after.rlike(r"^\.[a-z]{2,5}\b"), 1.0).otherwise(0.0),
        "address": F.when(before.rlike(r"(?i)(?:https?://|www\.)\S*$") | after.rlike(r"^@") | before.rlike(r"@$"), 1.0).otherwise(0.0),
        "key_word": F.when(near.rlike(f"(?:{KEY_WORDS})"), 1.0).otherwise(0.0),
        "hash_word": F.when(near.rlike(rf"\b(?:{HASH_WORDS})\b"), 1.0).otherwise(0.0),
        "assigned": F.when(before.rlike(r"[=:]\s*[\"'`]?$"), 1.0).otherwise(0.0),
        "quoted": F.when(before.rlike("[\"'`]$") & after.rlike("^[\"'`]"), 1.0).otherwise(0.0),
    }


def may_have_candidate(text: Column) -> Column:
    """False for texts without a candidate only."""
    found = F.lit(False)
    for parts, pattern in _SIGNS:
        sign = F.lit(True)
        for part in filter(None, parts):
            sign = sign & F.contains(text, F.lit(part))
        found = found | (sign if pattern is None else sign & text.rlike(pattern))
    return found


def _running(lengths: Column) -> Column:
    """Sums of the items before each item of an array, in blocks of ``PLACES`` items, so that no long array is copied for each item."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("all"))
    before = lambda xs: F.aggregate(
        xs, zero, lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["all"], a["at"]).alias("all")), lambda a: a["all"]
    )
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lengths) / PLACES).cast("int") - 1), lambda b: F.slice(lengths, b * PLACES + 1, F.lit(PLACES)))
    sums = before(F.transform(blocks, lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)))
    return F.flatten(F.zip_with(blocks, sums, lambda xs, at: F.transform(before(xs), lambda x: x + at)))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start (code points before it), before, candidate, after for each candidate of ``docs`` (doc_id, text)."""
    text = F.col("text")
    found = docs.filter(may_have_candidate(text) & text.rlike(CANDIDATE)).select(
        "doc_id", F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("c"), F.split("text", CANDIDATE, -1).alias("gaps")
    )
    steps = F.zip_with("gaps", "c", lambda g, c: (F.char_length(g) + F.coalesce(F.char_length(c), F.lit(0))).cast("long"))
    spans = F.arrays_zip(F.col("c"), F.col("gaps"), F.slice("gaps", 2, F.size("c")).alias("next"), F.col("ends").alias("from"))
    rows = found.withColumn("ends", _running(steps)).select(
        "doc_id",
        F.explode(F.transform(F.filter(spans, lambda s: s["c"].isNotNull()), lambda s: F.struct(
            (s["from"] + F.char_length(s["gaps"])).alias("start"), F.right(s["gaps"], F.lit(CONTEXT)).alias("before"),
            s["c"].alias("candidate"), F.left(s["next"], F.lit(CONTEXT)).alias("after"),
        ))).alias("x"),
    )
    return rows.select("doc_id", "x.*")


def _pick(seed: int, *choices: str) -> Column:
    """One of ``choices`` by the hash of the row's number."""
    return F.element_at(F.array(*map(F.lit, choices)), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(choices))) + 1).cast("int"))


def _hex(seed: int, n: int) -> Column:
    return F.left(F.sha2(F.concat_ws("-", F.col("id").cast("string"), F.lit(seed)), 512), F.lit(n))


def _mixed(seed: int, n: int) -> Column:
    """Letters of both cases and digits, from a hash."""
    coded = F.base64(F.unhex(_hex(seed, 128)))
    return F.left(F.regexp_replace(coded, "[+/=]", "k"), F.lit(n))


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """(before, candidate, after, label): half of the rows are secrets. The same rows at every call."""
    word = lambda s: _pick(s, *DICTIONARY)
    keys = _pick(1, "token", "secret", "password", "api_key", "apikey", "access_key", "auth token", "client_secret", "Bearer", "TOKEN")
    sets = _pick(2, " = \"", "=", ": ", "=\"", ": \"", " = ", " = '", "\": \"")
    close = _pick(3, "\" ", "\"", " ", "\n", "' ", ", ", "\"### ", "\"!! ")
    lead = F.concat(word(4), F.lit(" "), word(5), _pick(6, " ", "\n", ". ", "; "))
    phrase = F.concat(word(51), _pick(52, "-", "", "_", "."), word(53), _pick(54, "!", "#", "&", "1", "?"), F.substring(_hex(55, 3), 1, 3))
    spelled = F.concat(_mixed(56, 5), _pick(57, "!", "&", "#", "9", "*"), _mixed(58, 6))
    secret = F.element_at(
        F.array(
            phrase, spelled, F.concat(word(59), word(60), word(61)),
            _hex(11, 40), _hex(12, 32), _hex(13, 64), _mixed(14, 40), _mixed(15, 32), F.concat(F.lit("ghp_"), _mixed(16, 36)), F.upper(_hex(10, 40)),
            F.concat(F.lit("AKIA"), F.upper(_mixed(17, 16)), F.lit("7")), F.concat(F.lit("sk-"), _mixed(18, 44)), F.concat(F.lit("AIza"), _mixed(19, 35)),
        ),
        (F.pmod("id", F.lit(13)) + 1).cast("int"),
    )
    sha = F.concat(_pick(21, "sha256", "md5", "checksum", "commit", "digest", "etag", "revision", "sha1"), _pick(22, ":", ": ", "=", " "))
    false = F.element_at(
        F.array(
            F.struct(sha.alias("b"), _hex(23, 40).alias("c"), F.lit(" ").alias("a")),
            F.struct(sha.alias("b"), _hex(24, 64).alias("c"), F.lit("\n").alias("a")),
            F.struct(_pick(25, "id=", "uuid: ", "request ", "guid=").alias("b"), F.regexp_replace(_hex(26, 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-").alias("c"), F.lit(" ").alias("a")),
            F.struct(F.concat(F.lit("https://"), word(27), F.lit(".example.com/")).alias("b"), F.concat(word(28), F.lit("/"), _hex(29, 20), F.lit("/"), word(30)).alias("c"), F.lit(" ").alias("a")),
            F.struct(F.lit("in /").alias("b"), F.concat(word(31), F.lit("/"), word(32), F.lit("_"), F.lit("2024"), F.lit("/"), word(33)).alias("c"), F.lit(".txt").alias("a")),
            F.struct(F.concat(keys, sets).alias("b"), F.concat(_pick(34, "your_", "example_", "TEST_", "changeme_", "dummy-", "xxxxxxxx"), word(35), _pick(36, "_key_0000", "1234567890", "00000000")).alias("c"), close.alias("a")),
            F.struct(F.concat(word(37), F.lit(" ")).alias("b"), F.concat(word(38), word(39), word(40), F.lit("2"), word(41)).alias("c"), F.lit(" ").alias("a")),
            F.struct(F.lit("the ").alias("b"), F.regexp_replace(F.conv(_hex(42, 15), 16, 10), "^", "1").alias("c"), F.lit(" ").alias("a")),
            F.struct(F.lit("call ").alias("b"), F.concat(F.lit("+1-"), F.substring(F.conv(_hex(43, 12), 16, 10), 1, 10), F.lit("-555-01")).alias("c"), F.lit(" ").alias("a")),
            F.struct(F.lit("== ").alias("b"), F.concat(F.repeat(_pick(44, "-", "=", "_", "a"), 20), F.lit("1")).alias("c"), F.lit("\n").alias("a")),
            F.struct(F.concat(keys, sets).alias("b"), _pick(62, "required", "changeme", "optional", "placeholder", "undefined", "disabled", "redacted", "your-password", "xxxxxxxx", "********").alias("c"), close.alias("a")),
            F.struct(F.concat(keys, sets).alias("b"), F.concat(_pick(63, "${", "%(", "{{", "os.environ.", "config.", "process.env."), word(64), F.lit("_"), word(65), _pick(66, "}", ")s", "}}", "")).alias("c"), close.alias("a")),
            F.struct(F.concat(F.lit("the "), keys, F.lit(": ")).alias("b"), F.concat(_pick(67, "re", "un", "inter", "over"), word(68), _pick(69, "ing", "ed", "able", "ment")).alias("c"), F.lit(" ").alias("a")),
            F.struct(F.concat(_pick(70, "https", "postgres", "redis"), F.lit("://user:")).alias("b"), _pick(71, "password", "pass", "<password>", "PASSWORD", "$PASSWORD", "xxx").alias("c"), F.lit("@host/").alias("a")),
            F.struct(F.lit("mail ").alias("b"), F.concat(word(45), F.lit("."), word(46), F.substring(_hex(47, 4), 1, 4), F.lit("99")).alias("c"), F.lit("@mail.example.com").alias("a")),
        ),
        (F.pmod("id", F.lit(15)) + 1).cast("int"),
    )
    ids = spark.range(n // 2)
    named = F.struct(F.concat(lead, keys, sets).alias("b"), secret.alias("c"), close.alias("a"))
    address = F.struct(
        F.concat(lead, _pick(72, "https", "postgres", "mysql", "amqp", "redis"), F.lit("://"), word(73), F.lit(":")).alias("b"),
        F.when(F.col("id") % 2 == 0, phrase).otherwise(spelled).alias("c"), F.concat(F.lit("@"), word(74), _pick(75, ".net/", ":5432/", "/")).alias("a"),
    )
    kind = _pick(76, "RSA ", "EC ", "OPENSSH ", "")
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.left(F.base64(F.unhex(F.sha2(F.concat_ws("-", "id", i), 512))), F.lit(64))), "\n")
    block = F.struct(lead.alias("b"), F.concat(F.lit("-----BEGIN "), kind, F.lit("PRIVATE KEY-----\n"), body, F.lit("\n-----END "), kind, F.lit("PRIVATE KEY-----")).alias("c"), close.alias("a"))
    form = F.pmod(F.xxhash64("id", F.lit(77)), F.lit(8))
    good = ids.select(F.when(form == 0, address).when(form == 1, block).otherwise(named).alias("x")).select(
        F.col("x.b").alias("before"), F.col("x.c").alias("candidate"), F.col("x.a").alias("after"), F.lit(1.0).alias("label")
    )
    bad = ids.select(false.alias("x"), lead.alias("l")).select(
        F.concat("l", "x.b").alias("before"), F.col("x.c").alias("candidate"), F.col("x.a").alias("after"), F.lit(0.0).alias("label")
    )
    return good.union(bad)


def _with_features(rows: DataFrame) -> DataFrame:
    columns = features(F.col("before"), F.col("candidate"), F.col("after"))
    return VectorAssembler(inputCols=[f"f_{c}" for c in columns], outputCol="features").transform(
        rows.withColumns({f"f_{c}": v.cast("double") for c, v in columns.items()})
    ).drop(*(f"f_{c}" for c in columns))


def train(findings: DataFrame) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return forest.fit(_with_features(findings).select("features", "label"))


#: The model of the default findings, by application: trained once in each.
_trained: dict[str, RandomForestClassificationModel] = {}


def default_model(spark: SparkSession) -> RandomForestClassificationModel:
    key = spark.sparkContext.applicationId
    if key not in _trained:
        _trained.clear()
        _trained[key] = train(labelled_findings(spark))
    return _trained[key]


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, length, candidate, probability and is_secret for every candidate of ``docs`` (doc_id, text, ...).

    Candidates that the forest takes for false positives are returned with is_secret false. Null and empty
    texts have none; null doc_ids and repeated rows are scanned like others. An empty table gives no rows. Other columns are
    ignored.
    """
    model = default_model(docs.sparkSession) if findings is None else train(findings)
    scored = model.transform(_with_features(candidates(docs.select("doc_id", "text"))))
    p = F.round(vector_to_array("probability")[1], 6)
    return scored.select(
        "doc_id", F.col("start").cast("long").alias("start"), F.char_length("candidate").cast("long").alias("length"), "candidate",
        p.alias("probability"), (p >= threshold).alias("is_secret"),
    )
