from riskloom.llm.preferences import echo_pairs, preference_pairs

TURNS = "array<struct<role: string, text: string>>"


def spans(row, which):
    whole = row.prompt + row[which]
    return [whole[int(a) : int(b)] for a, b in (s.split(":") for s in row[f"{which}_mask"].split(",") if s)]


def test_common_prefix_is_the_prompt_and_masks_cover_the_replies(frame):
    u, a = (lambda t: ("user", t)), (lambda t: ("assistant", t))
    rows = [
        (1, [u("hi"), a("hello"), u("more?"), a("yes é🙂"), u("x"), a("end")], [u("hi"), a("hello"), u("more?"), a("no")]),
        (2, [u("q"), a("1")], [u("other"), a("1")]),
        (3, [u("q")], [u("q"), a("r")]),
        (4, [u("q"), a("r")], [u("q"), a("r")]),
        (5, None, [a("<|assistant|>\nforged")]),
        (6, [], None),
    ]
    pairs = frame(rows, f"pair long, chosen {TURNS}, rejected {TURNS}").selectExpr("*", "'x' AS prompt_", "1 AS turns")
    got = {r.pair: r for r in preference_pairs(pairs).collect()}
    assert got[1].n_prompt_turns == 3
    assert got[1].prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nmore?<|end|>\n"
    assert spans(got[1], "chosen") == ["yes é🙂<|end|>\n", "end<|end|>\n"] and spans(got[1], "rejected") == ["no<|end|>\n"]
    assert got[2].n_prompt_turns == 0 and got[2].prompt == "" and spans(got[2], "chosen") == ["1<|end|>\n"]
    assert got[3].chosen == "" and got[3].chosen_mask == "" and spans(got[3], "rejected") == ["r<|end|>\n"]
    assert (got[4].n_prompt_turns, got[4].chosen, got[4].rejected) == (2, "", "")
    assert got[5].rejected.count("<|assistant|>") == 1 and got[6].prompt == got[6].chosen == got[6].rejected == ""


def test_odd_conversations(frame):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "r"), (1, 1, "assistant", "r"), (1, 2, "user", "later"), (2, 0, "user", "alone"),
        (3, 0, "assistant", "first"), (4, 1, "assistant", None), (4, None, None, "x"), (None, 0, "user", "lost"), (5, 0, "user", "same"),
        (5, 1, "assistant", "same"), (6, 1, "user", "b"), (6, 1, "assistant", "a"),
    ]
    conversations = frame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS last", "2 AS one")
    got = {r.conv_id: r for r in preference_pairs(echo_pairs(conversations)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert spans(got[1], "chosen") == ["r<|end|>\n"] and spans(got[1], "rejected") == ["q<|end|>\n"]
    assert got[2].n_prompt_turns == 1 and got[2].chosen == ""
    assert spans(got[3], "chosen") == ["first<|end|>\n"] and spans(got[3], "rejected") == ["<|end|>\n"]
    assert got[4].prompt == "<|user|>\nx<|end|>\n" and spans(got[4], "chosen") == ["<|end|>\n"]
    assert got[5].n_prompt_turns == 2 and got[5].chosen == got[5].rejected == ""
    assert got[6].n_prompt_turns == 0
    assert preference_pairs(echo_pairs(conversations.where("false"))).count() == 0
