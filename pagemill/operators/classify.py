"""Categories for documents: by rules, by a Python function, or by an external program."""

from __future__ import annotations

import shlex
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions.fixed import SEPARATOR, SEPARATOR_VARIABLE


def rule_category(text: Column | str, rules: Sequence[tuple[str, str]], default: str = "") -> Column:
    """Category of the first rule whose pattern is found."""

    def category(t: Column) -> Column:
        found = F.lit(default)
        for name, pattern in reversed(rules):
            found = F.when(t.rlike(pattern), F.lit(name)).otherwise(found)
        return found

    return T.bind(F.col(text) if isinstance(text, str) else text, category)


def classify_rules(
    df: DataFrame, rules: Sequence[tuple[str, str]], col: Column | str = "content", default: str = ""
) -> DataFrame:
    """Adds ``classification`` from ordered ``(category, pattern)`` rules. No shuffle, no process, no Python.

    Each text is matched once, also when blank categories are dropped afterwards.
    """
    return T.once(df, "classification", rule_category(col, rules, default))


def classify_parts(parts: DataFrame, rules: Sequence[tuple[str, str]], col: Column | str = "content", default: str = "") -> DataFrame:
    """``(path, classification)`` of documents that are held in parts: the first rule whose pattern is found in any part.

    Each part is matched where it is; only the numbers of rules are shuffled, the least of each path. What a pattern would find
    only across the border of two parts is not found.
    """
    numbered = [(str(k), pattern) for k, (_, pattern) in enumerate(rules)]
    matched = classify_rules(parts, numbered, col, str(len(rules)))
    least = matched.groupBy("path").agg(F.min(F.col("classification").cast("int")).alias("rule"))
    names = F.array(*[F.lit(name) for name, _ in rules], F.lit(default))
    return least.select("path", F.get(names, F.col("rule")).alias("classification"))


def classify_udf(df: DataFrame, fn: Callable[[pd.Series], pd.Series], col: str = "content") -> DataFrame:
    """Adds ``classification`` from a function of a pandas series of texts.

    The function is declared nondeterministic, so a filter on its result does not make Spark call it a second time.
    """

    def categories(texts: pd.Series) -> pd.Series:
        return fn(texts)

    classify = F.pandas_udf(categories, "string").asNondeterministic()
    return df.withColumn("classification", classify(F.col(col)))


def _one_line(col: str) -> Column:
    """The text on one line and in one tab-separated field."""
    return F.regexp_replace(T.flatten(col), r"[\t\r\f]", " ")


# What would break a path out of its field, and how it is written instead.
_ESCAPES = (("%", "%25"), ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D"))


def _as_field(path: Column) -> Column:
    for plain, escaped in _ESCAPES:
        path = F.replace(path, F.lit(plain), F.lit(escaped))
    return path


def _from_field(field: Column) -> Column:
    for plain, escaped in reversed(_ESCAPES):
        field = F.replace(field, F.lit(escaped), F.lit(plain))
    return field


def _command_line(command: Sequence[str], sep: str) -> str:
    return f"{SEPARATOR_VARIABLE}={shlex.quote(sep)} {shlex.join(command)}"


def pipe_classify(
    df: DataFrame, command: Sequence[str], sep: str = SEPARATOR, col: str = "content"
) -> DataFrame:
    """``(path, classification)`` from an external program, run once per task.

    The program reads ``path<tab>text`` lines and writes ``path<tab>category`` lines. The path travels with the text,
    so a line the program drops or adds never moves a category to another document. ``%``, tabs and line ends in paths
    are percent-encoded on the way. Spark feeds the process straight from the JVM.
    """
    lines = df.select(_as_field(F.col("path")).alias("path"), _one_line(col).alias("line"))
    script = _command_line(command, sep).replace("\\", "\\\\").replace("'", "\\'")
    script = script.replace("{", "{{").replace("}", "}}")  # braces mark the DataFrame below
    fields = "ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\t'"
    answers = df.sparkSession.sql(
        f"SELECT TRANSFORM(path, line) {fields} USING '{script}' "
        f"AS (path STRING, classification STRING) {fields} FROM {{lines}}",
        lines=lines,
    )
    return answers.select(_from_field(F.col("path")).alias("path"), "classification")


def pipe_classify_lines(
    df: DataFrame, command: Sequence[str], sep: str = SEPARATOR, col: str = "content"
) -> DataFrame:
    """``(path, classification)`` from a program that knows nothing of paths: a line of text in, a category line out.

    The program runs once per task; lines go in from a thread of their own while answers are read, so neither side waits
    for the other's pipe and no more than an Arrow batch is held. Categories are attached by position. A program
    that does not answer each line with one line fails the job, since its answers cannot be told apart.
    """
    command = list(command)
    variable = SEPARATOR_VARIABLE

    def classify(frames):
        import os
        import queue
        import subprocess
        import threading

        import pandas as pd

        env = {**os.environ, variable: sep}
        program = subprocess.Popen(command, env=env, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        paths: queue.Queue = queue.Queue()
        failure: list[BaseException] = []

        def feed():
            try:
                with program.stdin as lines:
                    for frame in frames:
                        for path, line in zip(frame["path"], frame["line"]):
                            lines.write(f"{line}\n".encode())
                            paths.put((path,))
            except BaseException as e:
                failure.append(e)
            finally:
                paths.put(None)

        feeder = threading.Thread(target=feed, daemon=True)
        feeder.start()
        n_in = n_out = 0
        held: list[tuple] = []
        try:
            for answer in program.stdout:
                path = paths.get()
                n_out += 1
                if path is None:
                    raise ValueError(f"{n_in} documents in, more categories out")
                n_in += 1
                held.append((*path, answer.decode().removesuffix("\n")))
                if len(held) >= 2000:
                    yield pd.DataFrame(held, columns=["path", "classification"])
                    held = []
            feeder.join()
            if failure and not isinstance(failure[0], BrokenPipeError):
                raise failure[0]
            while paths.get() is not None:
                n_in += 1
            if n_in != n_out:
                raise ValueError(f"{n_in} documents in, {n_out} categories out")
            if program.wait():
                raise subprocess.CalledProcessError(program.returncode, command)
            if held:
                yield pd.DataFrame(held, columns=["path", "classification"])
        finally:
            program.kill()
            program.wait()

    lines = df.select("path", _one_line(col).alias("line"))
    return lines.mapInPandas(classify, "path string, classification string")


def attach_classification(docs: DataFrame, cats: DataFrame) -> DataFrame:
    """Documents with the category of their path; documents without one drop out.

    Categories are first reduced to one per path (partly before the shuffle), so copies of a document get the category
    once each and never multiply. Neither side is broadcast by hand: both grow with the data.
    """
    one = cats.groupBy("path").agg(F.max("classification").alias("classification"))
    return docs.join(one, "path")
