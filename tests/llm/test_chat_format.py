"""Rendering, spans and digests of conversations."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from seriesloom.llm import chat_format as cf

TEXT = st.lists(st.sampled_from(["a", "\\", "<", "|", ">", "[", "]", "/", "I", "N", "S", "T", "s", "é", "\n", cf.MARKERS[0],
                                *cf.CONTROL]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=6))
def test_texts_survive(turns):
    formatted, found = cf.spans(turns, cf.chat_template)
    assert cf.read_back(formatted) == turns
    assert [cf.unescape(formatted[a:b]) for a, b in found] == [t for _, t in turns]
    for _, text in turns:
        assert not any(c in cf.escape(text) for c in cf.CONTROL)


def test_templates_that_rewrite_history_are_found():
    def last_turn_only(turns):
        return "".join(f"[{r}]{t if i == len(turns) - 1 else ''}" for i, (r, t) in enumerate(turns))

    def closing(turns):
        return "<s>" + "".join(t for _, t in turns) + "</s>"

    def dropping(turns):
        return "".join(f"[{r}]" for r, _ in turns)

    turns = [("user", "one"), ("assistant", "two"), ("user", "three")]
    for template in (last_turn_only, closing, dropping):
        assert cf.spans(turns, template) == (template(turns), None)
    text, found = cf.spans(turns, lambda ts: "<s>" + "".join(f"{r}: {t.strip()}\n" for r, t in ts))
    assert [text[a:b] for a, b in found] == ["one", "two", "three"]


def expected(turns):
    joined = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(joined.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(cf.chat_template(turns)))


def test_conversations_in_spark(spark):
    rows = [(1, 2, "assistant", "two </s>"), (1, 0, "system", "be\\ nice"), (1, 1, "user", None),
            (2, 0, None, ""), (None, 0, "user", "lost"), (None, 1, "assistant", "found"),
            (3, 0, "user", "x" * 100_000), (3, 0, "user", "x" * 100_000), (3, None, "assistant", "first"),
            *[(4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(23)]]
    schema = "conv_id bigint, turn int, role string, text string"
    df = spark.createDataFrame([(*r, 5) for r in rows], schema + ", part int")
    want = {
        1: [("system", "be\\ nice"), ("user", ""), ("assistant", "two </s>")], 2: [("", "")],
        None: [("user", "lost"), ("assistant", "found")],
        3: [("assistant", "first"), ("user", "x" * 100_000), ("user", "x" * 100_000)],
        4: [("assistant" if i % 2 else "user", f"t{i}") for i in range(23)]}
    for size in (5, 1024):
        got = cf.digests(cf.format_conversations(df, part_turns=size)).collect()
        assert {r["conv_id"]: tuple(r)[1:] for r in got} == {k: expected(v) for k, v in want.items()}
        assert len(got) == len(want)
    assert cf.digests(cf.format_conversations(df.limit(0))).count() == 0


def preamble(turns):
    return "<s>be nice\n" + "".join(f"{r}: {t}\n" for r, t in turns)


def numbered(turns):
    return "".join(f"{i}. {r}: {t}\n" for i, (r, t) in enumerate(turns))


def forgetting(turns):
    """Rewrites turns once there are more than twenty."""
    return "".join(f"{r}: {t}\n" for r, t in turns[-20:])


def alternating(turns):
    assert all(a != b for (a, _), (b, _) in zip(turns, turns[1:]))
    return preamble(turns)


def test_history_reaches_over_part_borders():
    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(33)]
    for template in (preamble, numbered, alternating, cf.chat_template):
        whole = cf.spans(turns, template)
        assert whole[0] == template(turns) and len(whole[1]) == 33
        for size in (1, 2, 5, 16, 33):
            assert cf.spans(turns, template, size) == whole
    for size in (1, 2, 8, 1024):
        assert cf.spans(turns, forgetting, size) == (forgetting(turns), None)
    assert cf.spans([("system", "s"), *turns], alternating, 4)[0] == alternating([("system", "s"), *turns])


def test_long_conversations_are_rendered_in_steps():
    rendered = 0

    def counted(turns):
        nonlocal rendered
        rendered += len(turns)
        return preamble(turns)

    turns = [("assistant" if i % 2 else "user", "t") for i in range(4000)]
    assert cf.spans(turns, counted, 50)[0] == preamble(turns)
    assert rendered < 500_000  # 16 million turn by turn


def test_one_row_per_conversation_with_its_spans(spark):
    def begun(turns):  # local, so that it travels to the workers
        return "<s>" + "".join(f"{r}: {t}\n" for r, t in turns)

    def latest(turns):
        return begun(turns[-20:])

    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(23)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    row, = cf.format_conversations(df, render=begun, part_turns=4).collect()
    assert row["n_turns"] == 23 and not row["rewrites"]
    assert row["formatted"] == begun([(r, t) for _, _, r, t in rows])
    assert [row["formatted"][a:b] for a, b in zip(row["starts"], row["ends"])] == [f"t{i}" for i in range(1, 23, 2)]
    row, = cf.format_conversations(df, render=latest, part_turns=4).collect()
    assert row["rewrites"] and row["starts"] == []
