"""Python functions that calls in the data may name, and a registry to run them."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Names, arguments and results of the functions.


def add(a: int, b: int) -> int:
    """Sum of two whole numbers."""
    return a + b


def power_disco_ball(power: bool) -> bool:
    """Switches the disco ball; it always obeys."""
    return True


def start_music(energetic: bool, loud: bool, bpm: int) -> str:
    """Plays a song that fits; returns its title."""
    return "Never gonna give you up."


def dim_lights(brightness: float) -> bool:
    """Sets the lights, 0.0 is off and 1.0 full."""
    return True


HOUSE = [add, power_disco_ball, start_music, dim_lights]

_SQL_TYPES = {"int": "bigint", "bool": "boolean", "float": "double", "str": "string"}


class Registry:
    """Typed functions under their own names."""

    def __init__(self, functions: list[Callable]):
        self.functions = {fn.__name__: fn for fn in functions}

    def signatures(self, spark: SparkSession) -> DataFrame:
        """(name, position, argument, type): one row per declared argument."""
        rows = [
            (name, i, p.name, str(p.annotation))
            for name, fn in self.functions.items()
            for i, p in enumerate(inspect.signature(fn).parameters.values(), 1)
        ]
        return spark.createDataFrame(rows, "name string, position bigint, argument string, type string")

    def register(self, spark: SparkSession) -> None:
        """Makes each function callable from SQL, with Arrow between Spark and Python."""
        for name, fn in self.functions.items():
            returns = _SQL_TYPES[str(inspect.signature(fn).return_annotation)]
            spark.udf.register(name, F.udf(fn, returns, useArrow=True))

    def dispatch(self, name: Column, arguments: Column) -> Column:
        """struct(result, error): runs the function a row names with its JSON arguments.

        One vectorised pass serves all functions. An unknown name or arguments that do not fit
        land in ``error``; the row stays.
        """
        table = dict(self.functions)

        @F.pandas_udf("result string, error string")
        def run(names: pd.Series, texts: pd.Series) -> pd.DataFrame:
            out = []
            for called, text in zip(names, texts):
                if called not in table:
                    out.append((None, f"unknown function {called}"))
                    continue
                try:
                    out.append((json.dumps(table[called](**json.loads(text or "{}"))), None))
                except (TypeError, ValueError) as problem:
                    out.append((None, type(problem).__name__))
            return pd.DataFrame(out, columns=["result", "error"])

        return run(name, arguments)
