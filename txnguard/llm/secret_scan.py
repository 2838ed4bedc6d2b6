"""Secret scan with a random forest that removes false findings, in DataFrame functions only.

A regular expression proposes candidates: values of any length assigned to a secret's
name, quoted or not, known key formats, and runs of key characters with a digit. Each is described by its length, transitions between
character classes, how much of it dictionary words cover, whether it looks like a
path, and the words beside it. A random forest (Spark ML) trained from labelled
findings scores every candidate; those under ``threshold`` are false positives.

``labelled_findings`` labels candidates where there is no doubt: known formats
and values assigned to a secret's name are secrets, numbers and paths aren't. Any
other table with the same columns and a label can be used instead. The training
set is a bounded sample (``max_rows`` distinct ones, the lowest hashes of each label
alike, the labels weighted to equal shares); the scan covers all.

The expression takes a value in one possessive run and the closing punctuation is
trimmed from it afterwards, and masks are set by one cut of the text at all
places, so a text costs time in proportion to its length.

Cases: a null or empty text has no candidate. Texts of any length are read whole.
Findings belong to an id and a text: rows repeated with both yield them once; a
null id is an id of its own. Without labelled findings of both classes there is no
forest: labels beyond doubt stand (scores 1 and 0), other candidates have score
0.5. A score at the threshold is a secret. Places are counted in characters from
0. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import free_name, hash_cut, materialize

# Prefixes of public key formats.
PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|glpat-|xoxb-|xoxp-|sk_live_|rk_live_|AIza"
# Names that secrets are assigned to.
SECRET_NAMES = "token|secret|password|passwd|pwd|api_key|apikey|api-key|access_key|auth|bearer|credential|private_key"
# What stands right behind a secret's name and a sign: what is between quotes, or all up to a blank or quote; closing punctuation is trimmed later.
_QUOTED = "|".join(rf"(?<={q})(?=[^{q}\r\n]*+(?<=[^{q}\r\n]){q})(?=[^{q}\r\n\p{{L}}\p{{N}}]*+[\p{{L}}\p{{N}}])[^{q}\r\n]++" for q in "\"'`")
_BARE = r"(?![=:>])(?=[^\s\"'`\p{L}\p{N}]*+[\p{L}\p{N}])[^\s\"'`]++"
CLOSING = ".,;:)]}>"
_SIGN = r"[=:]{1,2}>?\s{0,4}[\"'`]?"
VALUE = rf"(?<=[=:>\s\"'`])(?<={_SIGN})(?<=(?i:{SECRET_NAMES})[0-9_-]{{0,4}}[\"'`]?\s{{0,4}}{_SIGN})(?:{_QUOTED}|{_BARE})"
CANDIDATE = rf"(?:{VALUE}|(?<![A-Za-z0-9+/_-])(?:(?:{PREFIXES})[A-Za-z0-9_-]{{12,}}|(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{12,}}={{0,2}}))"
# A small dictionary of words that fill names, paths and placeholders.
DICTIONARY = (
    "access account admin alpha answer april archive august backup beta build cache change changeme class client code common config content "
    "core count create data date december default delete demo density dummy empty error example factory february file first flag foobar "
    "format friday function group guest handler header hello home host html image import index input invalid item january json july june "
    "lang last level lib line list local login main manager march master message method model module monday month name network node none "
    "note november null number object october option order output page param parent password path place placeholder port private process "
    "product profile project proxy public query random record release remote report request resource response result root sample saturday "
    "schema script search second secret section september server service session setting simple size source start state static status "
    "string style sunday system table target temp test text thursday time title token tuesday type unknown update user util value version "
    "view wednesday window world"
).split()
FEATURES = ["length", "digits", "uppers", "lowers", "transitions", "coverage", "path", "named", "assigned", "quoted", "prose", "reference", "before_len", "after_len", *[f"word_{i}" for i in range(16)], *[f"next_{i}" for i in range(16)]]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, t, k, start, candidate, before, after): the k-th candidate of a document and up to 60 characters on either side."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text")).where(F.col("text").rlike(CANDIDATE))
    cut = rows.select("doc_id", "t", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE).alias("parts"))
    zipped = F.arrays_zip("found", F.slice("parts", 1, F.size("found")).alias("left"), F.slice("parts", F.lit(2), F.size("found")).alias("right"))
    # a neighbouring candidate is context too: every one has a character at least, so 60 of them on a side reach 60 characters
    before = "right(concat(array_join(transform(slice(z, greatest(i - 59, 1), i + 1 - greatest(i - 59, 1)), x -> concat(right(x.left, 60), right(x.found, 60))), ''), right(z[i].left, 60)), 60)"
    after = "left(concat(left(z[i].right, 60), array_join(transform(slice(z, i + 2, 60), x -> concat(left(x.found, 60), left(x.right, 60))), '')), 60)"
    told = F.expr(f"transform(sequence(0, size(z) - 1), i -> struct(z[i].found as found, length(z[i].left) as gap, {before} as before, {after} as after))")
    # behind explode it is made once a text, not once for each candidate that looks at it
    each = cut.select("doc_id", "t", F.explode(F.array(zipped)).alias("z")).where(F.size("z") > 0).select("doc_id", "t", F.posexplode(told).alias("k", "c")).select("doc_id", "t", "k", "c.*").dropDuplicates(["doc_id", "t", "k"])
    ahead = Window.partitionBy("doc_id", "t").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.length("found")).over(ahead) - F.length("found")
    # a value between quotes is taken whole; of any other, closing punctuation belongs to what follows
    quoted = F.right("before", F.lit(1)).isin("\"", "'", "`") & (F.right("before", F.lit(1)) == F.left("after", F.lit(1)))
    value = F.when(quoted, F.col("found")).otherwise(F.rtrim("found", F.lit(CLOSING)))
    placed = each.select("doc_id", "t", "k", start.alias("start"), value.alias("candidate"), "before", F.right("found", F.length("found") - F.length(value)).alias("closing"), "after")
    return placed.select("doc_id", "t", "k", "start", "candidate", "before", F.left(F.concat("closing", "after"), F.lit(60)).alias("after"))


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("candidate", f"[^{pattern}]", "")) / F.length("candidate")


def described(found: DataFrame, dictionary: list[str] = DICTIONARY) -> DataFrame:
    """``found`` with the forest's features."""
    classes = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace("candidate", "[A-Z]", "U"), "[a-z]", "l"), "[0-9]", "9"), "+/_-=", "#####")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    listed = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
    left = F.length(F.regexp_replace(F.lower("candidate"), f"(?:{listed})", ""))
    previous = F.lower(F.regexp_extract("before", r"([A-Za-z_-]+)[^A-Za-z]*$", 1))
    following = F.lower(F.regexp_extract("after", r"^[^A-Za-z]*+([A-Za-z_-]+)", 1))
    # used many times each, so made in a projection of their own
    names = [free_name(found, f"_{x}") for x in ("word", "next")]
    placed = found.withColumns({n: F.pmod(F.xxhash64(x), F.lit(16)) for n, x in zip(names, (previous, following))})
    word, after_word = map(F.col, names)
    yes = lambda c: c.cast("double")
    new = {
        "length": F.length("candidate").cast("double"), "digits": _share("0-9"), "uppers": _share("A-Z"), "lowers": _share("a-z"),
        "transitions": (runs - 1) / F.length("candidate"), "coverage": 1 - left / F.length("candidate"),
        "path": yes(F.col("candidate").rlike(r"^/|/.*/") | F.col("before").rlike(r"[./\\:]$") | F.col("after").rlike(r"^[./\\:@]")),
        "named": yes(F.lower(F.right("before", F.lit(24))).rlike(f"(?:{SECRET_NAMES})[^a-z]*$")),
        "assigned": yes(F.col("before").rlike(r"[=:]>?\s*[\"'`]?$")), "quoted": yes(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        # a plain word behind a colon in a running sentence; a variable, a call or a placeholder
        "prose": yes(F.col("candidate").rlike("^[A-Za-z]['a-z]*$") & F.col("before").rlike(r":[ \t]+$") & F.col("after").rlike(r"^[.,;:]?[ \t]+[A-Za-z]")),
        "reference": yes(F.col("candidate").rlike(r"^\$[{(A-Za-z_]|^[<{%(\[]|^[A-Za-z_][A-Za-z0-9_.]*[(\[]")),
        "before_len": F.length("before").cast("double"), "after_len": F.length("after").cast("double"),
        **{f"word_{i}": yes(word == i) for i in range(16)}, **{f"next_{i}": yes(after_word == i) for i in range(16)},
    }
    return placed.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in new.items()}).drop(*names)


def _label() -> Column:
    """1.0 or 0.0 where there is no doubt, NULL elsewhere."""
    secret = F.col("candidate").rlike(f"^(?:{PREFIXES})") | ((F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("coverage") < 0.5) & (F.col("prose") == 0) & (F.col("reference") == 0) & (F.col("length") >= 6))
    harmless = F.col("candidate").rlike("^[0-9+/_-]+$") | (F.col("coverage") > 0.6) | (F.col("prose") == 1) | (F.col("reference") == 1) | ((F.col("path") == 1) & (F.col("named") == 0))
    return F.when(secret, 1.0).when(harmless, 0.0)


def labelled_findings(found: DataFrame) -> DataFrame:
    """The rows of ``described`` candidates whose label is beyond doubt, with ``label`` 1.0 or 0.0."""
    return found.withColumn("label", _label()).where("label is not null")


def train(labelled: DataFrame, max_rows: int = 20_000, trees: int = 20, depth: int = 6) -> RandomForestClassificationModel | None:
    """A forest from a bounded sample of distinct labelled findings, half of it for each label; None if a class is missing from all of them."""
    keyed = labelled.withColumn("k", F.xxhash64("candidate", "before", "after"))
    cuts = [hash_cut(keyed.where(F.col("label") == label).select("k"), max_rows // 2) for label in (0.0, 1.0)]
    if None in cuts:
        return None
    chosen = ((F.col("label") == 0) & (F.col("k") <= cuts[0])) | ((F.col("label") == 1) & (F.col("k") <= cuts[1]))
    sample = materialize(keyed.where(chosen).select("k", "label", *FEATURES).dropDuplicates(["k", "label"]).drop("k"), "labelled")
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    weight = F.when(F.col("label") == 1, sum(n.values()) / (2 * n[1.0])).otherwise(sum(n.values()) / (2 * n[0.0]))
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=17)
    return forest.fit(_assembled(sample.withColumn("weight", weight)))


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)


def scored(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``described`` candidates with ``score``, the forest's probability that they are secrets; without one, their label or 0.5."""
    if model is None:
        return found.withColumn("score", F.coalesce(_label(), F.lit(0.5)))
    columns = found.columns
    return model.transform(_assembled(found)).select(*columns, vector_to_array("probability")[1].alias("score"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, t, k, start, candidate, score, secret) of every candidate; ``labelled``: findings with FEATURES and label."""
    found = materialize(described(materialize(candidates(docs), "secret_candidates")), "secret_features")
    model = train(labelled_findings(found) if labelled is None else labelled)
    return scored(found, model).select("doc_id", "t", "k", "start", "candidate", "score", (F.col("score") >= threshold).alias("secret"))


def redacted(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """The rows, with their own columns, every secret in ``text`` replaced by ``mark``; ``n_chars``, if there is one, follows."""
    secret = scan(docs, **options).where("secret")
    each = materialize(secret.groupBy("doc_id", "t").agg(F.array_sort(F.collect_list(F.struct("start", "candidate"))).alias("found")), "secrets").alias("s")
    joined = docs.alias("d").join(each, F.expr("d.doc_id <=> s.doc_id and xxhash64(d.text) = s.t"), "left")
    # four bytes a character, so that a place is found without counting characters; explode keeps it from being computed per secret
    wide = F.when(F.col("s.found").isNotNull(), F.encode(F.col("d.text"), "UTF-32"))
    joined = joined.select("d.*", F.col("s.found").alias(found := free_name(docs, "found")), F.explode(F.array(wide)).alias(chars := free_name(docs, "chars")))
    piece = lambda at, size: f"decode(concat(X'0000FEFF', substring(`{chars}`, cast(4 * ({at}) + 1 as int), cast(4 * ({size}) as int))), 'UTF-32')"
    end = lambda i: f"(`{found}`[{i}].start + length(`{found}`[{i}].candidate))"
    head = f"if(i = 0, 0, {end('greatest(i - 1, 0)')})"
    parts = F.expr(f"transform(sequence(0, size(`{found}`) - 1), i -> {piece(head, f'`{found}`[i].start - {head}')})")
    tail = F.expr(piece(end(f"size(`{found}`) - 1"), f"length(text) - {end(f'size(`{found}`) - 1')}"))
    text = F.when(F.col(found).isNull(), F.col("text")).otherwise(F.concat(F.array_join(parts, mark), F.lit(mark), tail))
    own = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = joined.select(*own, F.col(found).isNotNull().alias(changed := free_name(docs, "changed")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(changed), size).otherwise(F.col("n_chars")))
    return out.drop(changed)
