"""Batch inference over prompts.

The model call is an injected callable: ``backends`` maps a backend name to
a factory that is called once per partition and returns ``prompt -> text``.
Network clients are not part of this package. Results should be
materialised once (``session.written``) before several consumers
read them, so task retries and reuse never repeat a call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

Factory = Callable[..., Callable[[str], str]]


def echo_backend(temperature: float = 0.2, max_output_tokens: int = 10_000) -> Callable[[str], str]:
    """Stand-in for checks: reports the prompt's shape, a pure function of it."""
    def run(prompt: str) -> str:
        lines = prompt.split("\n")
        return f"  summary of {len(lines)} lines, {len(prompt)} characters\n"
    return run


DEFAULT_BACKENDS: dict[str, Factory] = {"echo": echo_backend}


def infer(prompts: DataFrame, backend: str, key: Sequence[str],
          prompt_col: str = "prompt",
          backends: Mapping[str, Factory] | None = None,
          partitions: int | None = None,
          options: Mapping[str, object] | None = None) -> DataFrame:
    """One call per prompt row -> ``key..., backend, summary, error``.

    Output is stripped. A failing call gives a null summary and the error
    text, so one bad prompt does not fail the job. An unknown backend is a
    ``ValueError`` before any task runs. Model calls are slow and few, and a
    prompt table is small (AQE may coalesce it into one partition), so
    ``partitions`` spreads the calls by hashing the key. ``options`` (such as
    ``temperature`` and ``max_output_tokens``) go to the backend's factory.
    """
    registry = dict(DEFAULT_BACKENDS if backends is None else backends)
    if backend not in registry:
        raise ValueError(f"unknown backend {backend!r}; known: {sorted(registry)}")
    factory, settings = registry[backend], dict(options or {})
    key = list(key)
    schema = StructType([prompts.schema[k] for k in key] + [
        StructField("backend", StringType()), StructField("summary", StringType()),
        StructField("error", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = factory(**settings)
        for pdf in batches:
            summaries, errors = [], []
            for p in pdf["__prompt"]:
                try:
                    summaries.append(fn(p).strip())
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - recorded per row
                    summaries.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            out = pdf[key].copy()
            out["backend"] = backend
            out["summary"] = summaries
            out["error"] = errors
            yield out

    src = prompts.select(*key, F.col(prompt_col).alias("__prompt"))
    if partitions:
        src = src.repartition(partitions, *key)
    return src.mapInPandas(run, schema)
