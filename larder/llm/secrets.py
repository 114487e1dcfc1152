"""Secret scans with corpus-wide ownership frequency.

Candidates are found by patterns in each text.  Their hashes are counted over distinct owners, repositories and texts: a
value that several owners or many repositories or texts have is a widely copied example; any other that looks random is
live-looking.
Only hashes leave the row of a text, and they are made distinct before they are counted, so a value in a third of all
rows costs a count per partition.

Null texts count as empty and have no spans; null owners and repositories count as one of their own.  Repeated rows
are scanned one by one; they share an owner, so copies by one owner stay owner-specific.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import session
from larder.llm.common import documents

#: A private key: up to its END line, whatever headers it has, or the lines of base64 that follow where END is missing.
_KEY_END = r"-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----((?:[^-]++|-(?!----))*+(?=" + _KEY_END + ")"
    r"|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{16,}+)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{1,15}+(?:=|\s*$)=?)?)(?:" + _KEY_END + ")?"
)
#: What a line of a key holds: a long run of base64 with a digit or sign among its letters, as no words of prose.
_KEY_LINE = r"(?<![A-Za-z0-9+/])(?=[A-Za-z]*[0-9+/])[A-Za-z0-9+/]{16,}"
#: Kinds in the order in which spans with equal starts are listed: (name, pattern, group of the value, its least length).
#: The patterns of access and hex ask for their lengths themselves, which finds the same maximal runs.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", _KEY, 1, 0),
    ("forge", r"gh[opsru]_[A-Za-z0-9]{36,}", 0, 40),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 35),
)
BASE, ASSIGN, KEY = 3, 0, 3
#: Columns that a scan makes itself.
_OWN = ("owner", "repository", "content", "spans", "row", "judged")
#: A value that so many owners, repositories or distinct texts have is an example, also where one owner has most rows.
MIN_OWNERS, MIN_REPOSITORIES, MIN_TEXTS = 3, 5, 20
_EXAMPLE = "(?i)example|sample|dummy|placeholder|changeme|your|xxxx|1234567|abcdef"


def _spans_of(text: Column, number: int) -> Column:
    """Spans of one kind: (start, kind, until, value), in code points, leftmost and non-overlapping."""
    _, pattern, group, least = KINDS[number]
    regex = F.lit(pattern)
    found = F.arrays_zip(
        F.regexp_extract_all(text, regex, F.lit(0)).alias("whole"), F.regexp_extract_all(text, regex, F.lit(group)).alias("value"),
        F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap)).alias("gap"),
    )
    span = "struct<start:int,kind:int,until:int,value:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["gap"]
        until = begin + F.coalesce(F.length(m["whole"]), F.lit(0))
        one = F.struct(begin.alias("start"), F.lit(number).alias("kind"), until.alias("until"), m["value"].alias("value"))
        kept = F.when(F.length(m["value"]) >= least, F.concat(acc["spans"], F.array(one))).otherwise(acc["spans"])
        return F.struct(until.alias("at"), kept.cast(f"array<{span}>").alias("spans"))

    spans = F.aggregate(found, start, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{span}>"))


def spans(text: Column) -> Column:
    """All spans of a text by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    return F.sort_array(F.concat(*[_spans_of(text, number) for number in range(len(KINDS))]))


def live_looking(value: Column, assigned: Column) -> Column:
    """Whether a value looks random: of many characters, with letters and digits, and no word of an example.

    A value that is assigned to the name of a secret may be short (6 to 11 characters), or without a digit if its capitals
    stand as in no word.  Short values without a digit, and words of one case, are no more than words.
    """
    several = lambda n: F.size(F.array_distinct(F.split(value, ""))) >= n
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    long = (F.length(value) >= 12) & several(8)
    scattered = value.rlike("[a-z]") & value.rlike("(?:[A-Z][a-z]?[A-Z].*){2}")
    return ((long & mixed) | (assigned & ((several(5) & mixed) | (long & scattered)))) & ~value.rlike(_EXAMPLE)


def live_key(body: Column) -> Column:
    """Whether the body of a private key, as it stands, is one: lines of base64 of 40 characters together, of many different ones.

    Prose that lies between the mention of a key's first and last line has no such lines, however long it is.
    """
    lines = F.array_join(F.regexp_extract_all(body, F.lit(_KEY_LINE), F.lit(0)), "")
    varied = F.size(F.array_distinct(F.split(lines, ""))) >= 16
    return (F.length(lines) >= 40) & varied & ~body.rlike("EXAMPLE|example|PLACEHOLDER|placeholder|xxxxxxxx|XXXXXXXX")


def scan(df: DataFrame, keep: list[str], text: str, owner: str, repository: str) -> DataFrame:
    """The kept columns, owner, repository, ``content`` (a hash of the text) and ``spans`` of (start, kind, until, hash, live): no values leave the row.

    A kept column that is named like one of these, ``row`` or ``judged`` comes back as ``kept_<name>``.
    """
    of_row = F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), F.xxhash64(F.col(text)).alias("content")
    own = [F.col(c).alias(f"kept_{c}" if c in _OWN else c) for c in keep]
    found = df.select(*own, *of_row, spans(F.col(text)).alias("spans"))
    # a key is the same however its lines are broken
    value = lambda s: F.when(s["kind"] == KEY, F.regexp_replace(s["value"], r"\s|\\[nr]", "")).otherwise(s["value"])
    live = lambda s: F.when(s["kind"] == KEY, live_key(s["value"])).otherwise(live_looking(s["value"], s["kind"] == ASSIGN))
    hidden = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["until"].alias("until"), F.sha2(value(s), 256).alias("hash"), live(s).alias("live"))
    return found.withColumn("spans", F.transform("spans", hidden))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories, n_texts) of candidates (hash, owner, repository, content)."""
    null = F.lit("\0null")
    rows = candidates.select("hash", F.coalesce("owner", null).alias("owner"), F.coalesce("repository", null).alias("repository")).distinct()
    repositories = rows.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    owners = repositories.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))
    return owners.join(candidates.select("hash", "content").distinct().groupBy("hash").agg(F.count("*").alias("n_texts")), "hash")


def judge(scanned: DataFrame, min_owners: int = MIN_OWNERS) -> DataFrame:
    """A scan's table (with a unique ``row``) with ``judged``: spans as (start, kind, until, n_owners, n_repositories, n_texts, verdict).

    The verdict is ``example`` (many owners, repositories or texts), ``live`` (fewer of all, live-looking) or ``unclear``.
    """
    one = scanned.filter(F.size("spans") > 0).select("row", "owner", "repository", "content", F.explode("spans").alias("s"))
    one = one.select("row", "owner", "repository", "content", "s.*")
    counted = one.join(ownership(one.select("hash", "owner", "repository", "content")), "hash")
    copied = (F.col("n_owners") >= min_owners) | (F.col("n_repositories") >= MIN_REPOSITORIES) | (F.col("n_texts") >= MIN_TEXTS)
    verdict = F.when(copied, "example").when(F.col("live"), "live").otherwise("unclear")
    span = F.struct("start", "kind", "until", "n_owners", "n_repositories", "n_texts", verdict.alias("verdict"))
    by_row = counted.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("judged"))
    return scanned.join(by_row, "row", "left")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(name) for name, *_ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["until"])), ",")


def redact(text: Column, judged: Column, mark: str = "[SECRET]") -> Column:
    """The text with its live spans replaced; overlapping spans are replaced as one."""
    live = F.filter(judged, lambda s: s["verdict"] == "live")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        out = F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["until"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(live) > 0, F.aggregate(live, start, step, rest)).otherwise(text)


def scanned_table(df: DataFrame, keep: list[str], text: str = "text", owner: str = "source") -> DataFrame:
    """A scan written once, with a unique ``row``; a repository is an owner's part in one language."""
    repository = F.concat_ws("/", F.col(owner).cast("string"), F.col("lang").cast("string"))
    rows = scan(df.withColumn("__repository", repository), keep, text, owner, "__repository")
    return session.materialise(rows.withColumn("row", F.monotonically_increasing_id()), "secrets")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(scanned_table(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"), ["doc_id"]))
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    with_verdict = lambda v: F.coalesce(F.size(F.filter("judged", lambda s: s["verdict"] == v)), F.lit(0)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < BASE)
    return rows.select(
        "doc_id", *[of_kind(k).alias(f"n_{KINDS[k][0]}") for k in range(BASE)], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), with_verdict("live").alias("n_live"), with_verdict("example").alias("n_examples"),
    )


QUERIES = {"op7_secrets": _query}
