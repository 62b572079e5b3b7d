"""Model calls over tables of prompts.

A model is whatever the caller hands over: ``make_client()`` runs once per task and returns a
function from a list of prompts to a list of texts. The offline client below needs no network and
answers the same way every time.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pa_fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.sources.staging import stage

Client = Callable[[list[str]], list[str]]
MakeClient = Callable[[], Client]

PROMPTS_PER_CALL = 64
CONTEXT_MARK = "Context: "

_SENTENCE = re.compile(r"[^.!?]*[.!?]?")


def extractive_client() -> Client:
    """Answers with the first sentence of the context, or of the prompt where none is marked."""
    def answer(prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            _, mark, context = prompt.partition(CONTEXT_MARK)
            out.append(_SENTENCE.match(context if mark else prompt).group())
        return out
    return answer


class Streaming:
    """A model that takes its prompts in pieces, so that no prompt needs to be held whole.

    ``begin`` opens a prompt, ``feed`` adds text to it and says whether more is wanted, ``finish`` gives the answers
    of some prompts in turn. A client of a server would pass the pieces on as they come; this one is the streaming
    twin of ``extractive_client``.
    """

    def begin(self):
        return _Reading()

    def feed(self, prompt, text: str) -> bool:
        return prompt.feed(text)

    def finish(self, prompts: list) -> Iterator[str]:
        for prompt in prompts:
            yield prompt.said()


class _Reading:
    """The first sentence after the context mark, or of the prompt, of a text read piece by piece."""

    def __init__(self):
        self.plain, self.marked, self.seen = _First(), None, ""

    def feed(self, text: str) -> bool:
        if self.marked is None:
            self.plain.feed(text)
            self.seen, mark, rest = (self.seen + text).partition(CONTEXT_MARK)
            self.seen = self.seen[1 - len(CONTEXT_MARK):]
            if not mark:
                return True
            self.marked, text = _First(), rest
        return self.marked.feed(text)

    def said(self) -> str:
        return "".join((self.plain if self.marked is None else self.marked).parts)


class _First:
    def __init__(self):
        self.parts, self.open = [], True

    def feed(self, text: str) -> bool:
        if self.open:
            self.parts.append(_SENTENCE.match(text).group())
            self.open = self.parts[-1][-1:] not in (".", "!", "?")
        return self.open


MakeStreaming = Callable[[], Streaming]


class Collecting(Streaming):
    """For clients that need a prompt in one string: pieces are kept by reference and joined one call at a time."""

    def __init__(self, client: Client | None = None, retries: int = 2, wait: float = 0.5):
        self.client, self.retries, self.wait = client, retries, wait

    def begin(self):
        return []

    def feed(self, prompt: list[str], text: str) -> bool:
        prompt.append(text)
        return True

    def finish(self, prompts: list[list[str]]) -> Iterator[str]:
        if self.client is None:
            yield from map("".join, prompts)
            return
        for lo in range(0, len(prompts), PROMPTS_PER_CALL):
            yield from _with_retries(self.client, ["".join(p) for p in prompts[lo:lo + PROMPTS_PER_CALL]], self.retries, self.wait)


def named_client(model: str) -> MakeClient:
    """The extractive answer signed with a model name, to tell answers of several models apart."""
    def make() -> Client:
        answer = extractive_client()
        return lambda prompts: [f"[{model}] {a.strip()}" for a in answer(prompts)]
    return make


def tagging_client(tag: str) -> MakeClient:
    """The extractive answer between tags."""
    def make() -> Client:
        answer = extractive_client()
        return lambda prompts: [f"<{tag}>{a}</{tag}>" for a in answer(prompts)]
    return make


TOPICS_MARK = "Topics: "


def topics_client() -> Client:
    """A guard: on-topic if the question holds one of the comma-separated topics of its prompt."""
    def answer(prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            guard, _, question = prompt.partition("\nQuestion: ")
            topics = guard.partition(TOPICS_MARK)[2].lower().split(", ")
            out.append("on-topic" if any(t and t in question.lower() for t in topics) else "off-topic")
        return out
    return answer


def _with_retries(client: Client, prompts: list[str], retries: int, wait: float) -> list[str]:
    for attempt in range(retries + 1):
        try:
            texts = client(prompts)
            break
        except (TimeoutError, ConnectionError):
            if attempt == retries:
                raise
            time.sleep(wait * 2 ** attempt)
    if len(texts) != len(prompts):
        raise ValueError(f"{len(prompts)} prompts, but {len(texts)} answers")
    return texts


def complete(
    df: DataFrame, prompt: str, out: str, make_client: MakeClient = extractive_client,
    retries: int = 2, wait: float = 0.5, skip_null: bool = False,
) -> DataFrame:
    """Adds ``out``: the model's plain text for the prompt column. With ``skip_null`` rows without a prompt are not sent.

    Calls happen inside the tasks, a bounded number of prompts at a time; timeouts are the
    client's and are retried a few times, anything else fails the task.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            sent = batch[prompt].notna() | (not skip_null)
            asked = batch.loc[sent, prompt].fillna("").tolist()
            said: list[str] = []
            for lo in range(0, len(asked), PROMPTS_PER_CALL):
                said += _with_retries(client, asked[lo:lo + PROMPTS_PER_CALL], retries, wait)
            answers = iter(said)
            yield batch.assign(**{out: [next(answers).strip() if s else None for s in sent]})

    return df.mapInPandas(run, schema)


def complete_logged(
    df: DataFrame, prompt: str, out: str, log: str, make_client: MakeClient = extractive_client,
    retries: int = 2, wait: float = 0.5,
) -> DataFrame:
    """``complete`` with a log of answers in the folder ``log``, so that no prompt is paid for twice.

    Every different prompt is asked once; rows share its answer. A task writes what a call has said into the log before the next
    call: when it runs again, after an error or on another machine, it asks only for what its part of the log does not
    have. A job that runs again asks only what the whole log does not have. ``log`` must be a folder that Spark and pyarrow both reach
    from all machines; it belongs to one model, and to one running job at a time.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", F.sha2(F.coalesce(F.col(prompt), F.lit("")), 256))
    said = _read_log(spark, log)
    asked = keyed.select("_key", F.coalesce(F.col(prompt), F.lit("")).alias("_prompt")).distinct()
    # on disk: a task that runs again must find the prompts it had
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    waiting = stage(asked.join(said, "_key", "left_anti").repartition(tasks, "_key"), "waiting")
    new = stage(waiting.mapInArrow(_asking(make_client, log, uuid.uuid4().hex, retries, wait), LOGGED), "answers")
    answers = said.dropDuplicates(["_key"]).unionByName(new).withColumnRenamed("_answer", out)
    return keyed.join(answers, "_key").select(*df.columns, out)


LOGGED = "_key string, _answer string"


def _read_log(spark: SparkSession, log: str) -> DataFrame:
    try:
        return spark.read.schema(LOGGED).option("recursiveFileLookup", "true").parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOGGED)


def _asking(make_client: MakeClient, log: str, job: str, retries: int, wait: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        client = make_client()
        part = TaskLog(log, f"{job}/{TaskContext.get().partitionId()}")
        known = part.answers()
        for batch in batches:
            prompts = dict(zip(batch.column("_key").to_pylist(), batch.column("_prompt").to_pylist()))
            open_ = [key for key in prompts if key not in known]
            for lo in range(0, len(open_), PROMPTS_PER_CALL):
                some = open_[lo:lo + PROMPTS_PER_CALL]
                texts = [t.strip() for t in _with_retries(client, [prompts[key] for key in some], retries, wait)]
                part.add(some, texts)
                known.update(zip(some, texts))
            yield pa.RecordBatch.from_arrays([pa.array(list(prompts), pa.string()), pa.array([known.pop(key) for key in prompts], pa.string())],
                                             ["_key", "_answer"])
    return run


class TaskLog:
    """The part of a log that one task writes: a small file for each call, which appears as a whole."""

    def __init__(self, log: str, part: str):
        self.fs, root = pa_fs.FileSystem.from_uri(log)
        self.folder = f"{root.rstrip('/')}/{part}"
        self.fs.create_dir(self.folder, recursive=True)

    def answers(self) -> dict[str, str]:
        out = {}
        for info in self.fs.get_file_info(pa_fs.FileSelector(self.folder)):
            if info.path.endswith(".parquet"):
                with self.fs.open_input_file(info.path) as file:
                    table = pq.read_table(file)
                out.update(zip(*(table.column(c).to_pylist() for c in ("_key", "_answer"))))
        return out

    def add(self, keys: list[str], answers: list[str]) -> None:
        name = f"{self.folder}/{uuid.uuid4().hex}"
        with self.fs.open_output_stream(f"{name}.open") as file:
            pq.write_table(pa.table({"_key": keys, "_answer": answers}), file)
        self.fs.move(f"{name}.open", f"{name}.parquet")


def embed_with(df: DataFrame, text: str, out: str, make_embedder: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """Adds a vector per text from a caller's model, called per Arrow batch like ``complete``."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = make_embedder()
        for batch in batches:
            if batch.num_rows:
                vectors = np.asarray(embed([t or "" for t in batch.column(text).to_pylist()]), dtype=np.float32)
                edges = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
                # what is not a number is null, as everywhere that rows come from pandas
                lists = pa.ListArray.from_arrays(edges, pa.array(vectors.reshape(-1), from_pandas=True))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)


# Letters and digits as they are, A-Z small, other ASCII a blank; bytes of other characters stay.
_ASCII = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))
_WORDS_KNOWN = 1 << 18


def digest_embedder(dims: int = 64) -> Callable[[list[str]], np.ndarray]:
    """An embedding that any engine can repeat: words counted by a bucket of their MD5, as whole thousandths of unit length.

    A-Z count as small letters; words are what ASCII characters other than letters and digits leave between them. As all values are
    whole numbers, so are squared distances, and nothing depends on the order of additions.
    """
    class Buckets(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = bucket = int(hashlib.md5(word).hexdigest()[:4], 16) % dims
            return bucket

    known = Buckets()

    def embed(texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), dims))
        for at in range(0, len(texts), 1000):
            words = [text.encode().translate(_ASCII).split() for text in texts[at:at + 1000]]
            row = np.repeat(np.arange(len(words)), list(map(len, words)))
            bucket = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, len(row))
            counts[at:at + len(words)] = np.bincount(row * dims + bucket, minlength=len(words) * dims).reshape(-1, dims)
            if len(known) > _WORDS_KNOWN:
                known.clear()
        size = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return np.floor(np.divide(1000 * counts, size, out=np.zeros_like(counts), where=size > 0))
    return embed


def model_matrix(prompts: DataFrame, key: list[str], prompt: str, clients: dict[str, MakeClient]) -> DataFrame:
    """(key, one answer column per model): every prompt given to every model.

    The models are columns of one row, so there is neither a cross join nor a pivot shuffle.
    """
    out = prompts
    for model, make in clients.items():
        out = complete(out, prompt, model, make)
    return out.select(*key, *clients)


def every_model(prompts: DataFrame, models: list[str]) -> DataFrame:
    """Every prompt once per model name, in long form."""
    return prompts.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
