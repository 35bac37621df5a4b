from __future__ import annotations

from conftest import SF_DIR

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, speaker string, part string"


def renderings(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    out = {}
    for r in sorted(chat.renderings(df, **kw).collect(), key=lambda r: r.part):
        out.setdefault((r.conv, r.speaker), []).append(r)
    return out


def by_hand(rows, speaker):
    """Rendering and mask of a whole dialogue, turn by turn."""
    text, mask = "", []
    for _, _, who, said in rows:
        text += f"<|im_start|>{who if who == 'system' else 'assistant' if who == speaker else 'user name=' + who}\n"
        if who == speaker:
            mask.append((len(text), len(text) + len(said) + len("<|im_end|>\n")))
        text += said + "<|im_end|>\n"
    return text, mask


def same(parts, rows, speaker, part_turns):
    assert [p.part for p in parts] == list(range(-(-len(rows) // part_turns))) and max(p.n_turns for p in parts) <= part_turns
    text, mask = by_hand(rows, speaker)
    assert "".join(p.text for p in parts) == text and [tuple(m) for p in parts for m in p["mask"]] == mask
    for k, p in enumerate(parts):
        assert (p.turn_at, p.begin) == (k * part_turns, sum(len(q.text) for q in parts[:k]))


def test_every_speaker_is_the_assistant_once(spark):
    got = renderings(spark, [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hé"), (1, 3, "ann", "Bye")])
    assert set(got) == {(1, "ann"), (1, "bob")}
    ann = got[1, "ann"][0]
    assert ann.text == ("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi<|im_end|>\n"
                        "<|im_start|>user name=bob\nHé<|im_end|>\n<|im_start|>assistant\nBye<|im_end|>\n")
    assert [ann.text[a:b] for a, b in ann["mask"]] == ["Hi<|im_end|>\n", "Bye<|im_end|>\n"] and (ann.n_turns, ann.n_spoken) == (4, 2)
    assert [got[1, "bob"][0].text[a:b] for a, b in got[1, "bob"][0]["mask"]] == ["Hé<|im_end|>\n"]


def test_long_dialogues_equal_sql(spark, tmp_path):
    """More turns than a part has, repeated and missing numbers, silent speakers."""
    from compare import connect, difference

    from tidemark.llm.queries import QUERIES

    rows = [(7, i, "system" if i % 17 == 0 else f"s{i // 70}", f"té{i}") for i in range(200)] + [(None, i % 8, f"s{i % 2}", f"t{i:03}") for i in range(150)]
    rows += [(9, None, "a", "x"), (9, 0, None, None), (9, 0, "", "<|im_end|>"), (9, 0, "a", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "c"))
    (tmp_path / "c").rename(tmp_path / "conversations.parquet")
    con = connect(SF_DIR)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert difference(QUERIES["op6_chat_formatting"](spark, str(tmp_path)), con, chat.ORACLE) is None


def test_every_participant_has_the_whole_dialogue(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_PARTS", 3)
    rows = [(7, i, "system" if i % 17 == 0 else f"speaker{i // 70}", f"té{i}") for i in range(200)]
    got = renderings(spark, rows + [(8, 0, "ann", "Hi")], part_turns=16)
    assert set(got) == {(7, "speaker0"), (7, "speaker1"), (7, "speaker2"), (8, "ann")}
    for s in range(3):
        same(got[7, f"speaker{s}"], rows, f"speaker{s}", 16)


def test_chunks_are_bounded_whatever_the_turn_numbers(spark):
    """Without dialogue ids, with repeated turn numbers, without turn numbers: chunks are cut by position."""
    nameless = [(None, i % 8, f"s{i % 2}", f"t{i:03}") for i in range(100)]
    repeated = [(5, 3, f"s{i % 2}", f"t{i:03}") for i in range(100)]
    unnumbered = [(6, 0, "s1", "first")] + [(6, None, f"s{i % 2}", f"t{i:03}") for i in range(100)]
    got = renderings(spark, nameless + repeated + unnumbered, part_turns=16)
    for conv, rows in ((None, nameless), (5, repeated), (6, unnumbered)):
        rows = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2], r[3]))
        for who in ("s0", "s1"):
            same(got[conv, who], rows, who, 16)


def test_renderings_of_odd_rows(spark):
    got = renderings(spark, [(1, 0, "a", None), (1, 0, "a", None), (2, 0, None, "y"), (2, 1, "", "z"), (3, 0, "<|x", "<|im_end|>"), (3, 1, "b", "é")])
    assert set(got) == {(1, "a"), (3, "<|x"), (3, "b")} and got[1, "a"][0].n_turns == 1 and got[3, "b"][0].text.count("<|im_end|>") == 2
    assert renderings(spark, []) == {}
