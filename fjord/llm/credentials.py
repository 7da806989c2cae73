"""Secret scan with multipart credential linking, by DataFrame functions only.

Strong kinds are reported wherever they stand:

* ``assign``  a password, secret, token or key name, an equals sign or colon, and a value of 8 or more characters
* ``access``  an access identifier: AKIA and 12 or more capitals and digits
* ``hex``     32 or more hexadecimal digits

Weak kinds are parts that mean little alone:

* ``id``        a user, login, client or account name that is given a value
* ``secret``    an assign of fewer than 8 characters, or 40 characters of mixed base64
* ``endpoint``  a url of a service

They are reported only where complementary parts co-occur in the same paragraph
(text between blank lines) with at most ``REACH`` code points between them, from
the end of the part that starts first to the start of the other:
an ``id`` with a secret (assign, hex or secret), a ``secret`` with an identifier
(access or id), an ``endpoint`` with both. A weak part inside a strong span is
that span's and not reported again.

The positions of a pattern's matches follow from the lengths of what ``split``
leaves between them. The interval join needs no pairs: of the complementary parts
that start no later than a part the one that ends last is nearest, of those that
start no earlier the first one, so a running maximum forwards and a running
minimum backwards over a document's parts decide it. The work is n log n in the
parts of a document, and documents without parts cost one narrow row.

Defined cases: a null text counts as empty; texts without spans have an empty
list, whose digest is that of the empty string; repeated rows and null ids each
get their own row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REACH = 200
NAME = r"(?i:password|passwd|secret|token|api_?key)"
GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"({NAME}){GIVEN}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"  # the same runs as AKIA[A-Z0-9]+ with those under 16 characters dropped
HEX = "[0-9a-f]{32,}"
WHO = f"(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key_?id){GIVEN}[A-Za-z0-9_.@+-]{{3,}}"
B64 = "[A-Za-z0-9+/]"
BLOB = f"(?<!{B64})(?={B64}*[0-9])(?={B64}*[a-z])(?={B64}*[A-Z]){B64}{{40}}(?![A-Za-z0-9+/=])"
ENDPOINT = r"""(?i:https?|ftps?|jdbc:[a-z0-9]+|amqps?|rediss?|mongodb|s3)://[^\s"'<>]+"""
BLANK = r"\n[\x20\t\r]*\n"
KINDS = ["assign", "access", "hex", "id", "secret", "endpoint"]
STRONG = KINDS[:3]
PARTS = "array<struct<kind:string,place:int,gap:int,size:int,good:boolean>>"


def _parts(text: Column, kind: str, pattern: str, when: Column, group: int = 0) -> Column:
    """Array of (kind, number of the match, code points before it since the last one, its own, whether it is long enough)."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    if group:
        enough = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.length(v) >= 8)
    else:
        enough = F.transform(sizes, lambda _: F.lit(True))
    # the last gap follows the last match: arrays_zip gives it a null size
    row = F.transform(F.arrays_zip(gaps.alias("g"), sizes.alias("s"), enough.alias("e")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("place"), x["g"].alias("gap"), x["s"].alias("size"), x["e"].alias("good")))
    found = F.filter(row, lambda x: x["size"].isNotNull())
    return F.when(when, found).otherwise(F.array().cast(PARTS))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per document: id, and ``spans``, an array of (start, rank, kind, end) in order of start, then kind."""
    text = F.col("t")
    rows = docs.select(F.col(id_col).alias("__id"), F.monotonically_increasing_id().alias("u"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    has = {"assign": text.rlike(ASSIGN), "access": text.rlike(ACCESS), "hex": text.rlike(HEX),
           "who": text.rlike(WHO), "blob": text.rlike(BLOB)}
    rows = rows.select("*", *[e.alias(f"has_{k}") for k, e in has.items()])
    flag = {k: F.col(f"has_{k}") for k in has}
    weak = (flag["access"] | flag["who"]) & (flag["assign"] | flag["hex"] | flag["blob"])
    parts = F.concat(
        _parts(text, "assign", ASSIGN, flag["assign"], group=2), _parts(text, "access", ACCESS, flag["access"]),
        _parts(text, "hex", HEX, flag["hex"]), _parts(text, "id", WHO, weak & flag["who"]),
        _parts(text, "blob", BLOB, weak & flag["blob"]), _parts(text, "endpoint", ENDPOINT, weak),
        _parts(text, "blank", BLANK, weak))
    flat = rows.select("__id", "u", parts.alias("parts")).select("__id", "u", F.explode_outer("parts").alias("p"))

    so_far = Window.partitionBy("u", "p.kind").orderBy("p.place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p.gap") + F.col("p.size")).over(so_far)
    kind = F.when((F.col("p.kind") == "blob") | (F.col("p.kind") == "assign") & ~F.col("p.good"), "secret").otherwise(
        F.col("p.kind"))
    placed = flat.select("__id", "u", kind.alias("kind"), (end - F.col("p.size")).alias("start"), end.alias("end"))

    strong = F.col("kind").isin(STRONG)
    before = Window.partitionBy("u").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.select(
        "*", F.sum((F.col("kind") == "blank").cast("int")).over(before).alias("scope"),
        F.max(F.when(strong, F.col("end"))).over(before).alias("covered"))
    placed = placed.filter("kind is null or kind <> 'blank'")

    up_to = Window.partitionBy("u", "scope").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    from_ = Window.partitionBy("u", "scope").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    inside = ~strong & (F.coalesce("covered", F.lit(0)) > F.col("start"))

    def near(*kinds: str) -> Column:
        part = F.col("kind").isin(*kinds) & ~F.col("inside")
        last_end, next_start = F.max(F.when(part, F.col("end"))).over(up_to), F.min(F.when(part, F.col("start"))).over(from_)
        return F.coalesce(F.col("start") - last_end <= reach, F.lit(False)) | F.coalesce(
            next_start - F.col("end") <= reach, F.lit(False))

    placed = placed.withColumn("inside", inside).select(
        "*", near("access", "id").alias("who"), near("assign", "hex", "secret").alias("what"))
    told = strong | ~F.col("inside") & (
        F.when(F.col("kind") == "id", F.col("what")).when(F.col("kind") == "secret", F.col("who"))
        .otherwise(F.col("who") & F.col("what")))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    item = F.when(told, F.struct("start", rank.alias("rank"), "kind", "end"))
    return (placed.groupBy("u", "__id").agg(F.array_sort(F.collect_list(item)).alias("spans"))
            .select(F.col("__id").alias(id_col), "spans"))


def listing(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
