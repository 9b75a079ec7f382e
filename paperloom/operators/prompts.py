"""Prompts, groups and the port to a language model (Q-1 to Q-9, L-6, P-13, T-25, U-3).

The wording is our own; what a reply has to hold is the contract of ``entries.unify_reply``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import jsonfix, text as X
from paperloom.operators.entries import TYPES

#: Q-6, fixed values: groups in order with their short names and types.
GROUPS = (
    ("GA_study_design", "study_design", ("concept", "relation", "dataset", "data_specification", "method", "experiment")),
    ("GB_results_claims", "results_claims", ("quantitative_result", "performance_result", "claim", "conclusion", "limitation", "future_work")),
    ("G1_concept_relation", "concept_relation", ("concept", "relation")),
    ("GC_concept", "concept", ("concept",)),
    ("GR_relation", "relation", ("relation",)),
    ("G2_dataset_spec", "dataset_spec", ("dataset", "data_specification")),
    ("G3_method_experiment", "method_experiment", ("method", "experiment")),
    ("G4_quant_perf", "quant_perf", ("quantitative_result", "performance_result")),
    ("G5_insight_outlook", "insight_outlook", ("conclusion", "claim", "future_work", "limitation")),
    ("GD_dataset", "dataset", ("dataset",)),
    ("GDS_data_specification", "data_specification", ("data_specification",)),
    ("GM_method", "method", ("method",)),
    ("GX_experiment", "experiment", ("experiment",)),
    ("GQR_quantitative_result", "quantitative_result", ("quantitative_result",)),
    ("GP_performance_result", "performance_result", ("performance_result",)),
    ("GCA_claim", "claim", ("claim",)),
    ("GCL_conclusion", "conclusion", ("conclusion",)),
    ("GLM_limitation", "limitation", ("limitation",)),
    ("GFW_future_work", "future_work", ("future_work",)),
)
NUMERIC = ("quantitative_result", "performance_result")
DEFAULT_GROUPS = ("study_design", "results_claims")


#: L-6, fixed value: the order in which the results of the groups are put together.
ORDER = (
    "GA_study_design", "GB_results_claims", "GC_concept", "GR_relation", "G1_concept_relation", "GD_dataset", "GDS_data_specification", "G2_dataset_spec", "GM_method", "GX_experiment",
    "G3_method_experiment", "GQR_quantitative_result", "GP_performance_result", "G4_quant_perf", "GCA_claim", "GCL_conclusion", "GLM_limitation", "GFW_future_work", "G5_insight_outlook",
)


def parse_spec(spec: str, strict: bool = False) -> list[list[str]]:
    """T-25: ``concept|dataset+method`` as groups of types; an unknown type is left out, or with ``strict`` an error."""
    out = []
    for part in filter(None, (p.strip() for p in spec.split("|"))):
        types = [t.strip() for t in part.split("+") if t.strip()]
        bad = [t for t in types if t not in TYPES]
        if bad and strict:
            raise ValueError(f"unknown types {bad}")
        types = [t for t in types if t in TYPES]
        if types:
            out.append(types)
    return out


def group_table(spark: SparkSession, names: tuple[str, ...] = DEFAULT_GROUPS, spec: str = "", strict: bool = False) -> DataFrame:
    """P-13, Q-6, L-6: (ord, grp, types, tables): the chosen groups in the order of their results; ``tables`` where a numeric type needs the view
    with tables. Own groups keep the number of their place in the spec and come with concept-bearing ones first. An unknown name is left
    out, so that there may be no group at all; with ``strict`` both are errors."""
    if spec:
        own = sorted(enumerate(parse_spec(spec, strict)), key=lambda x: "concept" not in x[1])
        rows = [(k, f"GX_custom_{i}", g, bool(set(g) & set(NUMERIC))) for k, (i, g) in enumerate(own)]
    else:
        known = {n: full for full, short, _ in GROUPS for n in (full, short)}
        bad = [n for n in names if n not in known]
        if strict and (bad or not names):
            raise ValueError(f"unknown groups {bad}")
        types = {full: t for full, _, t in GROUPS}
        chosen = {known[n] for n in names if n in known}
        rows = [(k, g, list(types[g]), bool(set(types[g]) & set(NUMERIC))) for k, g in enumerate(ORDER) if g in chosen]
    return spark.createDataFrame(rows, "ord int, grp string, types array<string>, tables boolean")


def metadata_prompt(text: Column | str, abstract: Column | str, introduction: Column | str, head: int = 5000) -> Column:
    """Q-2, T-24, T-26: the prompt for metadata: the head of the paper, and abstract and introduction where the head lacks them."""
    start = F.substring(X.c(text), 1, head)
    more = [F.when(X.c(p).isNotNull() & ~F.contains(X.prompt_content(start), X.prompt_content(p)), F.concat(F.lit(f"\n\n[{n}]\n"), X.c(p))).otherwise("") for n, p in (("abstract", abstract), ("introduction", introduction))]
    return F.concat(F.lit("Give title, year, DOI, keywords and up to three levels of discipline of this paper as one JSON object.\n\n[head]\n"), start, *more)


def group_prompts(papers: DataFrame, groups: DataFrame, budget: int = 100_000) -> DataFrame:
    """Q-3 to Q-5, Q-8: (source_key, ord, grp, types, view, prompt): a row a paper and group. Groups without numeric types see the text without
    tables cut to the budget, the others its front and tail with tables."""
    wide, label = X.front_tail("text", budget)
    views = papers.select("source_key", F.substring(X.strip_tables("text"), 1, budget).alias("__plain"), wide.alias("__wide"), label.alias("__label"))
    ask = F.concat(F.lit("List what the paper says as JSON with an array `entries`. Types: "), F.array_join("types", ", "), F.lit(".\nQuote for each a short passage word for word as evidence.anchor_text; give no page.\n\n"))
    j = views.crossJoin(F.broadcast(groups))  # the groups are the fixed list above
    return j.select("source_key", "ord", "grp", "types", F.when(F.col("tables"), F.col("__label")).otherwise("prefix").alias("view"), F.concat(ask, F.when(F.col("tables"), F.col("__wide")).otherwise(F.col("__plain"))).alias("prompt"))


@dataclass(frozen=True)
class Reply:
    text: str
    prompt_tokens: int = 0
    completion_tokens: int = 0


#: A client takes a prompt and gives a reply, or raises.
Client = Callable[[str], Reply]


class Busy(Exception):
    """The service asks for a pause."""


def replay(replies: dict[str, str]) -> Client:
    """A client that answers from recorded replies: the first recorded key that the prompt contains."""

    def ask(prompt: str) -> Reply:
        for k, v in replies.items():
            if k in prompt:
                return Reply(v, len(prompt) // 4, len(v) // 4)
        return Reply('{"entries": []}', len(prompt) // 4, 4)

    return ask


def ask(client: Client, prompt: str, attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> tuple[str | None, Reply | None, str | None]:
    """Q-1: (recovered JSON, reply, error): a call with retries: after a full service or a network error with growing pauses, after a reply
    without JSON at once."""
    error = None
    for k in range(attempts):
        try:
            reply = client(prompt)
            value = jsonfix.decode_reply(reply.text)
            if value is not None:
                return value, reply, None
            error = "no JSON in the reply"
        except (Busy, OSError, TimeoutError) as e:
            error = f"{type(e).__name__}: {e}"
            if k + 1 < attempts:
                pause(2.0**k)
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
    return None, None, error


def call(prompts: DataFrame, client: Client, attempts: int = 3) -> DataFrame:
    """Q-7, Q-9: prompts (source_key, ord, grp, …, prompt) with ``reply``, token counts and ``error``. The group of results is asked once
    more when it comes back empty, and fails then. Write the result before using it twice: a second evaluation would ask again."""
    cols = [c for c in prompts.columns if c != "prompt"]

    def run(batches):
        import json

        import pyarrow as pa

        def empty(v):
            d = json.loads(v)
            return not (d if isinstance(d, list) else any(isinstance(x, list) and x for x in d.values()))

        for b in batches:
            out = []
            at = b.schema.get_field_index("grp")
            for prompt, grp in zip(b.column(b.schema.get_field_index("prompt")).to_pylist(), b.column(at).to_pylist()):
                value, reply, error = ask(client, prompt, attempts)
                if grp == "GB_results_claims" and value is not None and empty(value):
                    value, reply, error = ask(client, prompt, attempts)
                    if value is not None and empty(value):
                        value, error = None, "empty twice"
                out.append((value, reply.prompt_tokens if reply else 0, reply.completion_tokens if reply else 0, error))
            new = [pa.array([o[i] for o in out], k) for i, k in enumerate((pa.string(), pa.int32(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in cols] + new, cols + ["reply", "prompt_tokens", "completion_tokens", "error"])

    from pyspark.sql import types as T

    schema = T.StructType([prompts.schema[c] for c in cols] + [T.StructField("reply", T.StringType()), T.StructField("prompt_tokens", T.IntegerType()), T.StructField("completion_tokens", T.IntegerType()), T.StructField("error", T.StringType())])
    return prompts.mapInArrow(run, schema)
