"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Only column functions are used. ``split`` and ``regexp_extract_all`` with one
pattern cut a text into gaps and matches, and their lengths give the positions.
Patterns are written with possessive quantifiers and look-behinds that change no
match but keep the work linear in texts without blanks, and free of recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, query, texts

# Kinds in their order, with pattern, base score in percent and context words.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 80, "mail|contact|write"),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", 60, "ip|host|server|address"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", 70, "card|visa|credit|payment"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 60, "phone|call|tel|mobile|fax"),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", 70, "iban|account|bank|konto|compte|cuenta"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 30, "ssn|social|security"),
)
BASE_KINDS = 4
CONTEXT = 40
CONTEXT_POINTS = 20
LEAST_SCORE = 50
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,score:int>"


def proposals(text: Column, pattern: str) -> Column:
    """Array of (start, end, value), leftmost and without overlaps, in code points."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<start:int,end:int,value:string>>").alias("out"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["gap"]
        end = (begin + F.length(pair["hit"])).cast("int")
        span = F.struct(begin.cast("int").alias("start"), end.alias("end"), pair["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(F.coalesce(acc["out"], empty), F.array(span)).alias("out"))

    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: p["hit"].isNotNull())
    return F.coalesce(F.aggregate(pairs, start, add)["out"], empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & luhn(digits(value))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


# Signs of a whole account number by country code.
IBAN_SIGNS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 "
    "GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 "
    "NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)
# Where an account number may begin: no two such places share a sign, though what follows them may.
IBAN_HEAD = r"[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
IBAN_LONGEST = 4 + 2 * 30  # with a blank before every sign after the head


def iban_length(value: Column) -> Column:
    """Length of the account number at the start of ``value``, a match of the pattern; 0 if there is none.

    The match may have run on into the words after the number: the signs its
    country has count first, then all of the match. Both must leave 1 mod 97.
    """
    country = F.try_element_at(F.create_map(*[F.lit(x) for c in IBAN_SIGNS.split() for x in (c[:2], int(c[2:]))]), F.substring(value, 1, 2))
    code = lambda i: F.ascii(F.substring(value, i, F.lit(1)))
    head = (code(F.lit(1)) - 55) * 10000 + (code(F.lit(2)) - 55) * 100 + F.substring(value, 3, 2).cast("int")
    state = lambda rest, signs, own, whole: F.struct(rest.alias("rest"), signs.alias("signs"), own.alias("own"), whole.alias("whole"))

    def add(acc: Column, i: Column) -> Column:
        c, signs = code(i), acc["signs"] + 1
        rest = F.when(c < 58, (acc["rest"] * 10 + c - 48) % 97).otherwise((acc["rest"] * 100 + c - 55) % 97)
        fine = (rest * 1000000 + head) % 97 == 1
        found = state(rest, signs, F.when(fine & (signs == country), i).otherwise(acc["own"]), F.when(fine & (i == F.length(value)), i).otherwise(acc["whole"]))
        return F.when(c == 32, acc).otherwise(found)

    first = state(F.lit(0), F.lit(4), F.lit(0), F.lit(0))
    return F.aggregate(F.sequence(F.lit(5), F.length(value)), first, add, lambda a: F.when(a["own"] > 0, a["own"]).otherwise(a["whole"]))


def iban_proposals(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of account numbers, leftmost and without overlaps.

    Every head is tried, also those within what another head's match ran over.
    """
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def tried(s: Column) -> Column:
        value = F.regexp_extract(F.substring(text, s["start"] + 1, F.lit(IBAN_LONGEST)), "^" + pattern, 0)
        n = iban_length(value)
        return F.struct(s["start"].alias("start"), (s["start"] + n).cast("int").alias("end"), F.substring(value, F.lit(1), n).alias("value"))

    def add(acc: Column, s: Column) -> Column:
        # One span at most for each that is kept: the last one's end decides.
        last = F.when(F.size(acc) > 0, F.element_at(acc, -1)["end"]).otherwise(0)
        return F.when((s["end"] > s["start"]) & (s["start"] >= last), F.concat(acc, F.array(s))).otherwise(acc)

    return F.aggregate(F.transform(proposals(text, IBAN_HEAD), tried), empty, add)


# A sign without which a pattern cannot match.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}


def _confirmed(text: Column, no: int) -> Column:
    """The proposals of one kind that its checks confirm, scored by the words around them."""
    kind, _, score, words = KINDS[no]

    def span(s: Column) -> Column:
        first = F.greatest(s["start"] - CONTEXT, F.lit(0))
        before = F.substring(text, first + 1, s["start"] - first)
        after = F.substring(text, s["end"] + 1, F.lit(CONTEXT))
        near = F.lower(F.concat_ws(" ", before, after)).rlike(words)
        return F.struct(
            s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            (F.lit(score) + F.when(near, CONTEXT_POINTS).otherwise(0)).alias("score"),
        )

    spans = F.transform(F.filter(F.col(f"_pii_{kind}"), lambda s: valid(kind, s["value"])), span)
    if no >= BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)
    return F.coalesce(spans, F.array().cast(f"array<{SPAN}>"))


def with_spans(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """The rows with an array of (start, kind_no, end, kind, score) in ``out``; null texts count as empty."""
    held = "_pii_text"
    df = df.withColumn(held, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    text = F.col(held)
    temporary = [held]
    for kind, pattern, *_ in KINDS:
        need = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(IBAN_HEAD if kind == "iban" else "[0-9]")
        found = iban_proposals(text, pattern) if kind == "iban" else proposals(text, pattern)
        df = df.withColumn(f"_pii_{kind}", F.when(need, found))
        temporary.append(f"_pii_{kind}")
    found = [_confirmed(text, no) for no in range(len(KINDS))]
    return df.withColumn(out, F.array_sort(F.concat(*found))).drop(*temporary)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of (start, kind_no, end, kind, score) by start and kind.

    An account number ends after the signs its country has, whatever follows it.
    Spans of the four base kinds are always kept; the score (percent) says how
    sure they are. Account and social numbers need ``LEAST_SCORE``. A null text
    counts as empty and has no spans; every input row gives one row, repeated
    rows too; a null id stays null.
    """
    return with_spans(texts(docs, id_col, text_col), "text", "spans").select("doc_id", "spans")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows as they are, with personal data in ``text_col`` replaced by its kind in angle brackets.

    Of spans that overlap, the one that starts first names the mark, and the mark
    stands for all of them. A null text stays null.
    """
    keep = docs.columns
    df = with_spans(docs, text_col, "_pii_spans")
    text = F.col(text_col).cast("string")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    out = F.aggregate(F.col("_pii_spans"), start, add, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    clean = F.when(F.size("_pii_spans") > 0, out).otherwise(text)
    return df.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in keep])


def joined(spans: Column, with_score: bool = False) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], *([s["score"]] if with_score else []))), ","
    )


def _sql() -> str:
    """The same in DuckDB, with plain greedy patterns."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    number = "regexp_replace(v, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({number}, length({number}) - i, 1) AS INT)"
    checks = {
        "email": "true",
        "ip": "len(list_filter(string_split(v, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(ltrim(p, '0'), 3) AS INT) > 255)) = 0",
        "card": f"length({number}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(0, length({number})), lambda i: "
        f"CASE WHEN i % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END)) % 10 = 0",
        "phone": f"length({number}) BETWEEN 10 AND 15",
        "iban": "list_reduce(list_prepend(0, list_transform(string_split(substr(replace(v, ' ', ''), 5) || left(replace(v, ' ', ''), 4), ''), lambda c: ord(c))), "
        "lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1",
        "ssn": "true",
    }
    ctes, unions = ["d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"], []
    for no, (kind, _, score, words) in enumerate(KINDS):
        p = patterns[kind]
        ctes.append(
            f"{kind}_h AS (SELECT r, t, string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}') AS h FROM d WHERE regexp_matches(t, '{p}'))"
        )
        ctes.append(
            f"{kind}_i AS (SELECT r, t, g, h, unnest(range(1, len(h) + 1)) AS i FROM {kind}_h)"
        )
        ctes.append(
            f"{kind}_s AS (SELECT r, t, h[i] AS v, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s FROM {kind}_i)"
        )
        near = f"lower(substr(t, greatest(s - {CONTEXT}, 0) + 1, s - greatest(s - {CONTEXT}, 0)) || ' ' || substr(t, s + length(v) + 1, {CONTEXT}))"
        sure = f"{score} + CASE WHEN regexp_matches({near}, '{words}') THEN {CONTEXT_POINTS} ELSE 0 END"
        least = f" AND {sure} >= {LEAST_SCORE}" if no >= BASE_KINDS else ""
        unions.append(f"SELECT r, s, {no} AS k, '{kind}:' || s || ':' || (s + length(v)) AS x, {sure} AS score FROM {kind}_s WHERE {checks[kind]}{least}")
    counts = ", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in KINDS[:BASE_KINDS])
    sums = ", ".join(f"CAST(count(*) FILTER (k = {no}) AS BIGINT) AS n_{k[0]}" for no, k in enumerate(KINDS[:BASE_KINDS]))
    return f"""WITH {", ".join(ctes)}, u AS ({" UNION ALL ".join(unions)}),
a AS (SELECT r, {sums}, string_agg(x, ',' ORDER BY s, k) FILTER (k < {BASE_KINDS}) AS base, string_agg(x, ',' ORDER BY s, k) AS spans,
  string_agg(x || ':' || score, ',' ORDER BY s, k) AS scored FROM u GROUP BY r)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scored, '') AS scored
FROM d LEFT JOIN a USING (r)"""


@query(_sql())
def op9_pii(spark, d):
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind_no"] < BASE_KINDS)
    return pii_spans(documents(spark, d)).select(
        "doc_id", *[n(k[0]) for k in KINDS[:BASE_KINDS]], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), joined(F.col("spans"), True).alias("scored"),
    )
