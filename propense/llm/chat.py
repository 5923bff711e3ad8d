"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, in ordinary marks: ``<turn>role<says>text</turn>`` for every turn, with the
marks inside roles and texts escaped reversibly. It is encoded once, with the offsets of the tokens, and
the sorted spans of the turns' texts are intersected with the sorted spans of the tokens by binary search:
the tokens that lie in an assistant's text are under the loss. The marks are tokens of their own, so no
token reaches over the edge of a text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

#: A byte-level vocabulary with offsets; the driver reads the file and sends its 1.5 MB to the tasks.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, SAYS, END = "<turn>", "<says>", "</turn>"
MARKS = (TURN, SAYS, END)
#: Strings that mean something to the template or the vocabulary, and so cannot stand in a text.
CONTROL = re.compile("|".join(map(re.escape, (*MARKS, "<|endoftext|>"))))
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
WHOLE = re.compile(f"{TURN}(.*?){SAYS}(.*?){END}", re.DOTALL)
LOSS_ROLES = ("assistant",)


def escape(text: str) -> str:
    """Without control strings: a backslash is doubled and their ``<`` becomes a backslash and ``(``."""
    return CONTROL.sub(lambda m: "\\(" + m.group()[1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "<" if m.group(1) == "(" else m.group(1), text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The conversation, and (start, end) of each turn's text in it, in characters."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``render`` was given."""
    return [(unescape(role), unescape(text)) for role, text in WHOLE.findall(formatted)]


def load(definition: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in MARKS])
    # offsets of tokens include their white space
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens (start, end) that share a character with one of the ``spans``; both ascend."""
    spans = spans[spans[:, 0] < spans[:, 1]]
    under = np.zeros(len(offsets), dtype=bool)
    if len(spans) and len(offsets):
        # the first span that ends after the token's start is the only one that can reach it first
        at = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")
        known = at < len(spans)
        under[known] = spans[at[known], 0] < offsets[known, 1]
    return under


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """A row per conversation: its id, ``formatted``, ``input_ids`` and ``loss`` (1 under the loss, else 0).

    Turns are ordered by number (null ones first), equal numbers by role and text; repeated rows are turns
    said again. Null roles and texts are empty ones; a null conversation id is a conversation of its own.
    Only the named columns are read, so others cannot clash. An empty table gives none. A conversation is
    one example and is in one task's memory; nothing larger is.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = turns.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load(definition.value)
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.iloc[k : k + 64]
                made = [render([(t["role"], t["text"]) for t in ts]) for ts in part["turns"]]
                codes = encoder.encode_batch([text for text, _ in made], add_special_tokens=False)
                losses = []
                for (_, spans), code, ts in zip(made, codes, part["turns"]):
                    wanted = np.array([t["role"] in loss_roles for t in ts], dtype=bool)
                    offsets = np.array(code.offsets, dtype=np.int64).reshape(-1, 2)
                    losses.append(mask(offsets, spans[wanted]).astype(np.int8))
                yield pd.DataFrame(
                    {
                        "conv_id": part["conv_id"].to_numpy(),
                        "formatted": [text for text, _ in made],
                        "input_ids": [code.ids for code in codes],
                        "loss": losses,
                    }
                )

    said = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    whole = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    kind = dict(said.dtypes)["conv_id"]
    made = whole.mapInPandas(run, f"conv_id {kind}, formatted string, input_ids array<int>, loss array<tinyint>")
    return made.withColumnRenamed("conv_id", conv_col)


def read_back(formatted: DataFrame, conv_col: str = "conv_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """What the output says: turns from ``formatted``, the text under the loss from the token ids alone."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = formatted.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = load(definition.value)
        for batch in batches:
            out = []
            for text, ids, loss in zip(batch["formatted"], batch["input_ids"], batch["loss"]):
                turns = parse(text)
                said = "".join(f"{role}\n{what}\n" for role, what in turns)
                under = np.asarray(ids)[np.asarray(loss, dtype=bool)].tolist()
                learnt = unescape(decoder.decode(under, skip_special_tokens=False))
                digest = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (said, learnt)]
                out.append((len(turns), digest[0], len(learnt), digest[1], len(text)))
            frame = pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield frame.assign(conv_id=batch["conv_id"].to_numpy())

    rows = formatted.withColumnRenamed(conv_col, "conv_id")
    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kind = dict(rows.dtypes)["conv_id"]
    return rows.mapInPandas(run, f"{schema}, conv_id {kind}").withColumnRenamed("conv_id", conv_col)
