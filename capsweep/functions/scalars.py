"""Column expressions: classification, text, dates, retry and backoff. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSIENT = (429, 502, 503, 504)
#: White space as scripts on the web see it: Unicode's, and the byte-order mark.
SPACE = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
#: A search's fields, of which the last two are the ends of its span of days.
SEARCH_FIELDS = ("numProcesso", "nomeParte", "nomeAdv", "classeJudicial", "documentoParte", "estadoComboOAB", "dataAutuacaoInicio", "dataAutuacaoFim")
REDACTED_FIELDS = ("cpf", "partyName", "jsessionid", "viewState", "ca")


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def text_or_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, f"{SPACE}+"), lambda x: x != "")


def cell_state(count: Column, cap: Column) -> Column:
    """complete, or truncated where the count reaches the cap; no cap means complete."""
    return F.when(cap.isNull() | (count < cap), "complete").otherwise("truncated")


def is_saturated(count: Column, cap: Column) -> Column:
    return F.coalesce(count >= cap, F.lit(False))


def set_hash(ids: Column) -> Column:
    """Of an array of ids; copies count, order doesn't."""
    return F.concat(F.lit("sha1:"), F.sha1(F.array_join(F.sort_array(F.coalesce(ids, F.array().cast("array<string>"))), "\n").cast("binary")))


def retry_after_ms(header: Column) -> Column:
    t = trimmed(header)
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint") * 1000)


def http_outcome(status: Column, header: Column) -> Column:
    """transient outcomes only; other statuses aren't classified."""
    return F.when(status.isin(*TRANSIENT), F.struct(F.lit("transient").alias("kind"), status.cast("int").alias("status"), retry_after_ms(header).alias("retry_after_ms")))


def validity(expired: Column, unprimed: Column, defect: Column, redirect: Column, shell: Column, valid: Column) -> Column:
    """The first that holds, in this order."""
    return (
        F.when(expired, "sessionExpired").when(unprimed, "unprimedSession").when(defect, "hostDefect")
        .when(redirect, "hostDefect").when(shell, "invalidTokenShell").when(valid, "validData").otherwise("unclassified")
    )


def failure_reason(kind: Column, status: Column, reason: Column, detail: Column) -> Column:
    return (
        F.when(kind == "transient", F.concat(F.lit("transient:"), F.coalesce(status.cast("string"), F.lit("unknown"))))
        .when(kind == "sessionExpired", "sessionExpired")
        .otherwise(F.concat(F.coalesce(reason, kind), F.when(detail.isNotNull(), F.concat(F.lit(":"), detail)).otherwise("")))
    )


def unresolved_reason(kind: Column, reason: Column, most: int = 256) -> Column:
    clean = F.regexp_replace(F.concat(kind, F.lit(":"), reason), r"[\x00-\x1F\x7F-\x{9F}]", " ")
    return F.left(trimmed(F.regexp_replace(clean, f"{SPACE}+", " ")), F.lit(most))


def decision(kind: Column, status: Column, attempt: Column, backoff_ms: Column, retry_after: Column, transient_cap: int = 5, defect_cap: int = 2, session_cap: int = 1) -> Column:
    """STRUCT<action, delay_ms> for a failed attempt (counted from 1)."""
    def to(action, delay):
        return F.struct(F.lit(action).alias("action"), delay.cast("bigint").alias("delay_ms"))
    zero = F.lit(0)
    return (
        F.when((kind == "transient") & (attempt > transient_cap), to("stop", zero))
        .when((kind == "transient") & (status == 429), to("requeue", F.coalesce(retry_after, backoff_ms)))
        .when(kind == "transient", to("retry", F.coalesce(retry_after, backoff_ms)))
        .when((kind == "sessionExpired") & (attempt <= session_cap), to("reprime", zero))
        .when((kind == "hostDefect") & (attempt <= defect_cap), to("retry", backoff_ms))
        .otherwise(to("stop", zero))
    )


def backoff(kind: str, n: Column, base: float, step: float = 0.0, jitter: float = 0.0, cap: float | None = None, seed: int = 0) -> Column:
    """fixed: base; linear: base + step * (n - 1); exponential: base * step^(n - 1); then jitter, then the cap."""
    d = {"fixed": F.lit(float(base)), "linear": F.lit(float(base)) + F.lit(float(step)) * (n - 1), "exponential": F.lit(float(base)) * F.pow(F.lit(float(step)), n - 1)}[kind]
    if jitter:
        d = d + (F.rand(seed) * 2 - 1) * jitter * d
    return F.least(d, F.lit(float(cap))) if cap is not None else d


def labelled_code(text: Column) -> Column:
    """`label (123)` or `label (123` -> STRUCT<label, code>; else the whole as label."""
    t = trimmed(text)
    pattern = r"^(.*?)\s*\((\d+)\)?$"
    hit = t.rlike(pattern)
    return F.struct(F.when(hit, F.regexp_extract(t, pattern, 1)).otherwise(t).alias("label"), F.when(hit, F.regexp_extract(t, pattern, 2)).alias("code"))


def subjects(text: Column) -> Column:
    t = trimmed(F.regexp_replace(text, f"{SPACE}+", " "))
    return F.when(t == "", F.array()).otherwise(F.transform(F.split(t, r"\s+-\s+"), labelled_code))


def party(line: Column) -> Column:
    """`name - CPF|CNPJ: id (ROLE)` -> STRUCT<name, cpf, cnpj, role>; no role is UNKNOWN. An id has digits and ./- only."""
    t = trimmed(line)
    role = F.nullif(trimmed(F.regexp_extract(t, r"\(([^()]+)\)$", 1)), F.lit(""))
    rest = F.when(role.isNotNull(), trimmed(F.regexp_replace(t, r"\([^()]+\)$", ""))).otherwise(t)
    pattern = r"^(.+?)\s*-\s*(CPF|CNPJ):\s*([\d./-]+)$"
    kind, number = F.regexp_extract(rest, pattern, 2), F.regexp_extract(rest, pattern, 3)
    return F.struct(
        F.when(rest.rlike(pattern), trimmed(F.regexp_extract(rest, pattern, 1))).otherwise(rest).alias("name"),
        F.when(kind == "CPF", number).alias("cpf"), F.when(kind == "CNPJ", number).alias("cnpj"),
        F.coalesce(role, F.lit("UNKNOWN")).alias("role"),
    )


def lawyer(line: Column) -> Column:
    """`name - OAB UFnumber - CPF: id (ADVOGADO)` -> STRUCT<name, oab_state, oab_number, cpf>; any other line is a name."""
    t = trimmed(line)
    pattern = r"^(.+?)\s*-\s*OAB\s+([A-Z]{2})([\w-]+)\s*-\s*CPF:\s*([\d.-]+)\s*\(ADVOGADO\)$"
    part = lambda k: F.when(t.rlike(pattern), trimmed(F.regexp_extract(t, pattern, k)))
    return F.struct(F.coalesce(part(1), t).alias("name"), part(2).alias("oab_state"), part(3).alias("oab_number"), part(4).alias("cpf"))


def document_type(label: Column) -> Column:
    return F.nullif(F.regexp_extract(trimmed(label), r"\(([^()]*)\)$", 1), F.lit(""))


def declared_total(footer: Column) -> Column:
    return F.coalesce(F.regexp_extract(footer, r"(\d+)\s+resultados? encontrados?", 1).try_cast("int"), F.lit(0))


def party_names(text: Column) -> Column:
    """The sides of `A X B`, without ` e outros (N)`."""
    bare = F.transform(F.split(text, r"\s+X\s+"), lambda x: trimmed(F.regexp_replace(x, r"\s+e outros(\s*\(\d+\))?\s*$", "")))
    return F.filter(bare, lambda x: x != "")


def bigrams(name: Column) -> Column:
    """Neighbouring pairs of a name's tokens, in order."""
    t = tokens(name)
    return F.when(F.size(t) < 2, F.array().cast("array<string>")).otherwise(F.zip_with(F.slice(t, F.lit(1), F.size(t) - 1), F.slice(t, F.lit(2), F.size(t) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))


def two_tokens(probe: Column) -> Column:
    """The probe, or an error if it has fewer than two tokens."""
    return F.when(F.size(tokens(probe)) >= 2, probe).otherwise(F.raise_error(F.lit("a probe needs two tokens")))


def local_timestamp(raw: Column, zone: str = "-03:00") -> Column:
    """`dd/MM/yyyy HH:mm:ss` at a fixed offset -> ISO UTC with milliseconds; anything else is null."""
    ok = F.when(raw.rlike(r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$"), raw)
    return F.date_format(F.to_utc_timestamp(F.try_to_timestamp(ok, F.lit("dd/MM/yyyy HH:mm:ss")), zone), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def br_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def last_segment(name: Column) -> Column:
    return F.substring_index(name, ":", -1)


def field_named(fields: Column, semantic: str) -> Column:
    """The first harvested field whose last segment contains the semantic name."""
    return F.try_element_at(F.filter(fields, lambda f: F.contains(last_segment(f), F.lit(semantic))), F.lit(1))


def redacted(fields: Column, names=REDACTED_FIELDS) -> Column:
    keys = F.array(*map(F.lit, names))
    return F.transform_values(fields, lambda k, v: F.when(F.array_contains(keys, k), "[REDACTED]").otherwise(v))


def lower_headers(headers: Column) -> Column:
    return F.transform_keys(headers, lambda k, _: F.lower(k))


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 5) == F.lit(b"%PDF-"), F.lit(False))


def safe_component(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Za-z0-9._-]+$"), F.lit(False))


def search_body(criteria: dict[str, Column], harvested: Column, view_state: Column, trigger: Column) -> Column:
    """array of STRUCT<name, value>: all of a search's fields under their harvested names, absent ones empty, and the
    form's own. Both ends of the span of days must be given; a field that wasn't harvested is an error."""
    ends = SEARCH_FIELDS[-2:]
    missing = [k for k in ends if k not in criteria]
    if missing:
        raise ValueError(f"a search needs {' and '.join(missing)}")
    pair = lambda k, v: F.struct(k.alias("name"), v.alias("value"))
    said = lambda text: F.raise_error(F.lit(text)).cast("string")
    value = lambda k: F.coalesce(criteria.get(k, F.lit(None).cast("string")), F.lit(""))
    given = lambda k: F.when(value(k) == "", said(f"a search needs {k}")).otherwise(value(k)) if k in ends else value(k)
    name = lambda k: F.coalesce(field_named(harvested, k), said(f"no field {k} was harvested"))
    own = lambda k, v: pair(F.lit(k), F.lit(v))
    return F.array(own("AJAXREQUEST", "_viewRoot"), *[pair(name(k), given(k)) for k in SEARCH_FIELDS], own("fPP", "fPP"), pair(F.lit("javax.faces.ViewState"), view_state), pair(trigger, trigger), own("AJAX:EVENTS_COUNT", "1"))


def rendered_fields(fields: Column) -> Column:
    """`k=v` of a map, nulls left out."""
    return F.array_join(F.transform(F.map_entries(F.map_filter(fields, lambda _, v: v.isNotNull())), lambda e: F.concat(e["key"], F.lit("="), e["value"])), " ")


def grid_summary(documents: Column, declared: Column) -> Column:
    fetched = F.size(F.filter(documents, lambda d: d["fetchStatus"] == "fetched"))
    return F.struct(declared.alias("declaredTotal"), fetched.alias("extractedCount"), (F.size(documents) - fetched).alias("skippedCount"), (declared - F.size(documents)).alias("reportedGap"))


def with_outcome(documents: Column, document_id: Column, status: Column) -> Column:
    """documents with the status of every one of that id set."""
    return F.transform(documents, lambda d: F.when(d["documentId"] == document_id, d.withField("fetchStatus", status)).otherwise(d))


def harvested_seeds(parties: Column) -> Column:
    """array of STRUCT<kind, value>: distinct lawyers' numbers, then parties', in order."""
    everyone = F.concat(parties["active"], parties["passive"], parties["others"])
    distinct = lambda a: F.array_distinct(F.filter(a, lambda x: x.isNotNull() & (x != "")))
    lawyers = F.flatten(F.transform(everyone, lambda p: F.transform(p["lawyers"], lambda w: w["cpf"])))
    seed = lambda kind: lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    return F.concat(F.transform(distinct(lawyers), seed("lawyerCpf")), F.transform(distinct(F.transform(everyone, lambda p: p["cpf"])), seed("partyCpf")))
