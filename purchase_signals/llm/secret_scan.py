"""Secrets in texts, told apart by how many owners hold them.

Patterns find candidates and their spans. The hash of each candidate's value is
counted over the whole corpus by distinct owners and repositories: a value that
many owners hold is a copied example; one that a single owner holds and that looks
like a real credential is taken to be live. Everything is built-in expressions;
spans come from the gaps between matches, so a text is matched and split once
for each kind. Frequencies are combined before the shuffle, and a value that a
third of all rows hold is joined by a skew join like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialise

# The kinds in their order, pattern, group of the value, its least length.
BASE_KINDS = [
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
MORE_KINDS = [
    ("github", r"\bgh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("jwt", r"\beyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 24),
    ("slack", r"\bxox[abprs]-[A-Za-z0-9-]+", 0, 16),
    # To its END line, or to the next key or the end of the text if there is none.
    (
        "private_key",
        r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----(.*?)"
        r"(?:-----END [A-Z ]*PRIVATE KEY-----|(?=-----BEGIN [A-Z ]*PRIVATE KEY-----)|\z)",
        1,
        0,
    ),
]
# Patterns with the least length built in where that finds the very same spans.
_QUICK = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
_PLACEHOLDER = "(?i)example|sample|dummy|changeme|placeholder|your|xxxx|0123456789|abcdefgh"
_PLACEHOLDER_WORD = f"(?<![A-Za-z0-9+/])(?:{_PLACEHOLDER})(?![A-Za-z0-9+/])"


# Found in every text that holds a match of any kind, in few others.
_TRACE = "|".join(
    [
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
        r"AKIA[A-Z0-9]{12}",
        r"[0-9a-f]{32}",
        r"\bgh[pousr]_[A-Za-z0-9]",
        r"\beyJ[A-Za-z0-9_-]+\.eyJ",
        r"\bxox[abprs]-",
        r"PRIVATE KEY-----",
    ]
)


def may_hold_secrets(text: Column) -> Column:
    """Whether ``text`` could have a span; decided in one pass, without a look at other rows."""
    return F.coalesce(F.regexp_like(text, F.lit(_TRACE)), F.lit(False))


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """``array<struct<kind, start, end, value>>`` of a kind's matches, in code points."""
    pattern = F.lit(_QUICK.get(kind, pattern))
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    found = F.zip_with(
        whole, value, lambda w, v: F.struct(F.length(w).cast("long").alias("n"), v.alias("value"))
    )
    # A match begins where the gaps and matches before it end.
    empty = F.expr("cast(array() as array<struct<kind:string,start:long,end:long,value:string>>)")
    placed = F.aggregate(
        F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        lambda state, x: F.struct(
            (state["at"] + x["g"] + F.coalesce(x["m"]["n"], F.lit(0))).alias("at"),
            F.when(
                F.length(x["m"]["value"]) >= least,
                F.concat(
                    state["spans"],
                    F.array(
                        F.struct(
                            F.lit(kind).alias("kind"),
                            (state["at"] + x["g"]).alias("start"),
                            (state["at"] + x["g"] + x["m"]["n"]).alias("end"),
                            x["m"]["value"].alias("value"),
                        )
                    ),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return F.when(F.regexp_like(text, pattern), placed).otherwise(empty)


def _looks_live(kind: Column, value: Column) -> Column:
    """Not a placeholder, of at least eight different characters, some of them digits.

    A private key needs no digit. It is long enough to hold a placeholder's letters by
    chance, so there they count only as a word.
    """
    key = kind == "private_key"
    placeholder = F.when(key, F.regexp_like(value, F.lit(_PLACEHOLDER_WORD))).otherwise(
        F.regexp_like(value, F.lit(_PLACEHOLDER))
    )
    return (
        ~placeholder
        & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
        & (key | F.regexp_like(value, F.lit("[0-9]")))
    )


def _listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then in the order of the kinds, joined by commas."""
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).alias("place"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(keyed), told), ",")


def candidates(docs: DataFrame, *, owner: Column, repository: Column) -> DataFrame:
    """Each row of ``docs (doc_id, text)`` with its ``spans``; values only as hashes."""
    text = F.coalesce("text", F.lit(""))
    by_kind = [_spans(F.col("text"), *kind) for kind in BASE_KINDS + MORE_KINDS]
    found = docs.select("doc_id", text.alias("text"), owner.alias("owner"), repository.alias("repository"))
    found = found.select("doc_id", "owner", "repository", F.concat(*by_kind).alias("spans"))
    return found.withColumn(
        "spans",
        F.transform(
            "spans",
            lambda s: F.struct(
                s["kind"].alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.sha2(s["value"], 256).alias("hash"),
                _looks_live(s["kind"], s["value"]).alias("live"),
            ),
        ),
    )


def ownership(found: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: in how many distinct ones each candidate occurs."""
    held = found.select("owner", "repository", F.explode("spans.hash").alias("hash"))
    pairs = held.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    return (
        pairs.groupBy("hash", "owner")
        .agg(F.sum("one").alias("repositories"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    )


def scan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: Column | None = None,
    shared_by: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """``(documents, findings)`` of all rows of ``docs``.

    ``documents``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for each
    row. ``findings``: ``doc_id, kind, start, end, hash, owners, repositories, verdict`` for
    each span; the verdict is ``copied`` if at least ``shared_by`` owners hold the value,
    else ``live`` if it looks like a credential, else ``unlikely``. A null text is an empty
    one; null owners are one owner. Repeated rows each give their own; further
    columns are passed over.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.col(owner).alias("_owner"),
        (F.col(owner) if repository is None else repository).alias("_repository"),
    )
    found = materialise(
        candidates(rows, owner=F.col("_owner"), repository=F.col("_repository")), "secrets"
    )
    kinds = [k[0] for k in BASE_KINDS + MORE_KINDS]
    base = [k[0] for k in BASE_KINDS]
    of = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    documents = found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_listed(of(*base), kinds), 256).alias("base_sha256"),
        _listed(F.col("spans"), kinds).alias("spans"),
    )
    verdict = (
        F.when(F.col("owners") >= shared_by, "copied").when(F.col("live"), "live").otherwise("unlikely")
    )
    findings = (
        found.select("doc_id", F.explode("spans").alias("s"))
        .select("doc_id", "s.*")
        .join(ownership(found), "hash")
        .select("doc_id", "kind", "start", "end", "hash", "owners", "repositories", verdict.alias("verdict"))
    )
    return documents, findings


def masked(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with ``mark`` in place of each of ``spans``; those that overlap count as one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    done = F.aggregate(
        F.array_sort(spans),
        start,
        lambda state, s: F.when(
            s["start"] >= state["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    state["parts"],
                    F.array(
                        F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
                    ),
                ).alias("parts"),
            ),
        ).otherwise(
            F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["parts"].alias("parts"))
        ),
        lambda state: F.array_join(
            F.concat(
                state["parts"],
                F.array(F.substring(text, (state["at"] + 1).cast("int"), F.length(text))),
            ),
            mark,
        ),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
