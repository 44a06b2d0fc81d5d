"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) to a string. Turn k's span is what
the rendering of the first k turns adds to that of the first k - 1; if the longer output
does not begin with the shorter one, the template rewrites history, which is reported and
leaves the conversation without spans. Where a turn's text lies inside its span is found
by rendering the same prefix with a marker as its text.

Conversations are dealt to tasks by id and read in order of turns; a template may look at any
turn, so a task holds one conversation whole. The work would grow with the square of the
turns, so beyond `part_turns` turns a part's turns are rendered behind the first two alone,
and at the part's end all turns so far are rendered once: where that is what the parts before
and the steps of this one add up to, the steps stand, and where it is not (the template
looks further back), the part is rendered again from the first turn on, turn by turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked

#: Strings that steer a model; the template below uses the first three, texts may hold any.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.S)
MARKERS = [chr(c) for c in range(0xE000, 0xF8FF)]  # private code points; one stands for a text that is looked for

Turns = list[tuple[str, str]]


def escape(text: str) -> str:
    """Double every backslash and part every control string with one."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def chat_template(turns: Turns) -> str:
    return "".join(f"<|im_start|>{escape(role)}<|im_sep|>{escape(text)}<|im_end|>\n" for role, text in turns)


def read_back(formatted: str) -> Turns:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _steps(history: Turns, turns: Turns, render: Callable[[Turns], str]) -> tuple[str, list[tuple[int, int]]] | None:
    """What `turns`, one by one behind `history`, add to the rendering, and where their texts lie in that."""
    before, out = render(history), []
    base = len(before)
    held = list(history)
    for role, text in turns:
        marker = next(m for m in MARKERS if m not in role)
        probe = render([*held, (role, marker)])
        held.append((role, text))
        now = render(held)
        if not (now.startswith(before) and probe.startswith(before)):
            return None
        own, frame = now[len(before):], probe[len(before):]
        if frame.count(marker) != 1:
            return None
        head, tail = frame.split(marker)
        if not (own.startswith(head) and own.endswith(tail) and len(own) >= len(head) + len(tail)):
            return None
        out.append((len(before) + len(head) - base, len(now) - len(tail) - base))
        before = now
    return before[base:], out


def spans(turns: Turns, render: Callable[[Turns], str],
          part_turns: int = 1024) -> tuple[str, list[tuple[int, int]] | None]:
    """The whole rendering and where each turn's text lies in it; None if history is rewritten,
    or a text cannot be told from what surrounds it."""
    part_turns += part_turns % 2  # who speaks next behind two turns speaks next behind an even number
    whole, out = render([]), []
    for a in range(0, len(turns), part_turns):
        own = turns[a:a + part_turns]
        steps = _steps(turns[:min(a, 2)], own, render)
        if a and (steps is None or render(turns[:a + len(own)]) != whole + steps[0]):
            steps = _steps(turns[:a], own, render)
        if steps is None:
            return render(turns), None
        out += [(len(whole) + x, len(whole) + y) for x, y in steps[1]]
        whole += steps[0]
    return whole, out


def _parts(batches, render, learned, part_turns):
    """One row per conversation; rows arrive ordered by conversation and turn."""
    held: Turns = []
    key = None

    def row():
        text, found = spans(held, render, part_turns)
        loss = [s for s, (role, _) in zip(found or [], held) if role == learned]
        return (key[0], text, len(held), found is None, [s for s, _ in loss], [e for _, e in loss])

    for frame in batches:
        rows = []
        for name, none, role, text in zip(frame["id"], frame["none"], frame["role"], frame["text"]):
            name = None if none else name
            if key is not None and key != (name,):
                rows.append(row())
                held = []
            key = (name,)
            held.append((role, text))
        yield _frame(rows)
    if held:
        yield _frame([row()])


def _frame(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["id", "formatted", "n_turns", "rewrites", "starts", "ends"])
    return out.astype({"id": object})


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", render: Callable[[Turns], str] = chat_template,
                         learned: str = "assistant", part_turns: int = 1024) -> DataFrame:
    """Per conversation: `id`, `formatted`, `n_turns`, `rewrites`, and the loss mask as `starts`
    and `ends` (code points in `formatted`) of the texts of role `learned`.

    Null roles and texts count as empty. Turns with the same number, and repeated rows, are
    all kept, ordered by role and text; a null number comes first. Rows without an id are one
    conversation.
    """
    turns = picked(rows, id=id_col, turn=turn_col, role=role_col, text=text_col).select(
        "id", F.col("id").isNull().alias("none"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    kind = turns.schema["id"].dataType.simpleString()
    ordered = turns.repartition("id").sortWithinPartitions("id", "turn", "role", "text")
    return ordered.mapInPandas(
        lambda batches: _parts(batches, render, learned, part_turns),
        f"id {kind}, formatted string, n_turns int, rewrites boolean, starts array<int>, ends array<int>")


def _digests(batches):
    """Digests of each conversation, read back from its formatted text."""
    for frame in batches:
        rows = []
        for name, text, starts, ends in zip(frame["id"], frame["formatted"], frame["starts"], frame["ends"]):
            turns = read_back(text)
            said = hashlib.sha256("".join(f"{role}\n{own}\n" for role, own in turns).encode("utf-8", "surrogatepass"))
            loss = "".join(unescape(text[start:end]) for start, end in zip(starts, ends))
            rows.append((None if pd.isna(name) else name, len(turns), said.hexdigest(), len(loss),
                         hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
        yield pd.DataFrame(rows, columns=["id", "n", "turns", "chars", "loss", "size"]).astype({"id": object})


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation: the id, `n_turns`, `turns_sha256`, `loss_chars`, `loss_sha256`, `formatted_chars`.

    Takes `format_conversations` made with `chat_template`.
    """
    kind = formatted.schema["id"].dataType.simpleString()
    return formatted.mapInPandas(
        _digests, f"id {kind}, n bigint, turns string, chars bigint, loss string, size bigint").select(
        F.col("id").alias(id_col), F.col("n").alias("n_turns"), F.col("turns").alias("turns_sha256"),
        F.col("chars").alias("loss_chars"), F.col("loss").alias("loss_sha256"),
        F.col("size").alias("formatted_chars"))
