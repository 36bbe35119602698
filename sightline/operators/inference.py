"""Opaque model calls over tables.

A model is a Python function from a batch of requests to a batch of answers, registered under a name. Equal requests are
asked once; answers already stored are not asked again; an answer that breaks its contract is asked again with the error
as feedback and, after the last attempt, becomes a row with default values and the error; a request too large for the model
becomes such a row at once. Any other error ends the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.text import content_key
from sightline.operators.delivery import clipped_lists
from sightline.session import written

#: A request batch (its columns and ``feedback``, null at first) gives one answer per row: a dict or an exception.
Model = Callable[[pd.DataFrame], list]

_models: dict[str, Model] = {}


class InvalidAnswer(ValueError):
    """An answer that breaks its contract."""


class OverContext(ValueError):
    """A request too large for its model. It is not asked again."""


def register(name: str, model: Model) -> None:
    _models[name] = model


def call(requests: DataFrame, columns: list[str], model: str | Model, answer: str, defaults: dict, memo: DataFrame | None = None, attempts: int = 3, key: str = "call_key") -> DataFrame:
    """``requests`` with the model's answer columns, ``attempts``, ``error`` and ``call_key``.

    ``answer`` is the DDL of the answer columns, ``defaults`` their values where no valid answer came. ``memo`` holds
    earlier results by ``call_key`` (rows with an error are asked again). Requests are told apart by ``columns``; nulls
    among these are values of their own.
    """
    ask = _models[model] if isinstance(model, str) else model
    keyed = requests.withColumn(key, content_key(*[F.col(c) for c in columns]))
    unique = keyed.select(key, *columns).dropDuplicates([key])
    names = [f.name for f in T.StructType.fromDDL(answer).fields]
    done = None
    if memo is not None:
        done = memo.filter("error is null").select(key, *names, "attempts", "error")
        unique = unique.join(done.select(key), key, "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left = batch.assign(feedback=None)
            out = []
            for n in range(1, attempts + 1):
                answers = ask(left.drop(columns=[key]))
                if len(answers) != len(left):
                    raise RuntimeError(f"{len(answers)} answers to {len(left)} requests")
                again = []
                for k, a in zip(left[key], answers):
                    if isinstance(a, OverContext):
                        out.append((k, *[defaults[c] for c in names], n, str(a)))
                    elif isinstance(a, InvalidAnswer):
                        again.append((k, str(a)))
                        if n == attempts:
                            out.append((k, *[defaults[c] for c in names], n, str(a)))
                    elif isinstance(a, Exception):
                        raise a
                    else:
                        out.append((k, *[a[c] for c in names], n, None))
                if not again:
                    break
                told = dict(again)
                left = left[left[key].isin(told)].assign(feedback=lambda d: d[key].map(told))
            yield pd.DataFrame(out, columns=[key, *names, "attempts", "error"])

    asked = unique.mapInPandas(run, f"{key} string, {answer}, attempts int, error string")
    answers = asked if done is None else asked.unionByName(done)
    return keyed.join(answers, key)


_BOXES = "boxes array<struct<x1:double,y1:double,x2:double,y2:double,score:double>>"


def ground(requests: DataFrame, columns: list[str], model: str | Model, key: str = "request_id", attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """Detections and markers of grounding ``requests`` (``key``, width, height and the model's ``columns``).

    The model answers each request with a list of dicts x1, y1, x2, y2, score (null: none), or an exception as in ``call``.
    Detections: key, detection_index (from 0, in the model's order), the box clipped to the image, score; boxes that are
    then invalid are left out. Markers: key, detections, attempts, error; one for each distinct key, written before anything
    reads the detections, so that a marked request is a finished one. Answers are stored by a job that runs when this is called.
    """
    asked = requests.select(key, "width", "height", *columns).dropDuplicates([key])
    answers = call(asked, [key, *columns], model, _BOXES, {"boxes": []}, attempts=attempts)
    stored = written(answers.select(key, clipped_lists("boxes", "width", "height").alias("boxes"), "attempts", "error"), "grounded")
    found = stored.select(key, F.posexplode("boxes").alias("detection_index", "_b")).select(key, "detection_index", "_b.*")
    return found, stored.select(key, F.size("boxes").alias("detections"), "attempts", "error")


def pair_key(first: str, second: str):
    """The same key for a pair in either order."""
    a, b = F.col(first).cast("string"), F.col(second).cast("string")
    return content_key(F.least(a, b), F.greatest(a, b))
