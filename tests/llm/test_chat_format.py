import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from twinsift.llm import chat_format as C
from twinsift.llm import queries

CONV = "conv_id long, turn long, role string, text string"


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool|>", "a\\|", ""]),
                          st.text(alphabet="</s>[INST]\\|<role:end>SY ok\n", max_size=40)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_template_round_trip(turns):
    text = "".join(C.format_turn(r, t)[0] for r, t in turns)
    assert C.parse_turns(text) == turns


def test_no_control_string_survives_in_a_text():
    for s in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|end|>", "\\[INST]"):
        assert s.lstrip("\\") not in C.escape(f"a{s}b{s}{s}") and C.unescape(C.escape(s)) == s


def brute(rows):
    out = {}
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [(1, 0, "system", "S"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "more"), (1, 4, "assistant", "</s>"),
        (2, 0, "system", "S"), (2, 1, "user", "hi"), (2, 2, "assistant", "other"), (3, 0, "system", "S"), (3, 1, "user", "hi"),
        (4, 0, "user", None), (4, 1, "assistant", ""), (5, 1, "user", "hi"), (5, 0, "system", "S"), (5, 2, "assistant", "hello"),
        (6, None, "user", "a"), (6, 0, None, "b"), (None, 0, "user", "x"), (7, 0, "user", "same"), (7, 0, "user", "same")]


def test_reads_back_and_shares_nodes(spark, frame):
    tree, convs = C.prefix_tree(frame(ROWS, CONV))
    got = {r["conv_id"]: tuple(r)[1:5] for r in C.digests(C.read_conversations(tree, convs)).collect()}
    assert got == brute(ROWS)
    nodes = sorted(tree.collect(), key=lambda r: r["start"])
    paths = {c: tuple((r or "", x or "") for cc, _, r, x in sorted(ROWS, key=lambda y: (str(y[0]), y[1] is not None, y[1] or 0)) if cc == c)
             for c in {r[0] for r in ROWS}}
    assert len(nodes) == len({p[:i + 1] for p in paths.values() for i in range(len(p))})
    # Depth first without gaps; ancestors come before and their lengths give
    # the position ids.
    at = 0
    for n in nodes:
        assert n["start"] == at and n["length"] == len(n["tokens"])
        at += n["length"]
        assert n["position"] == sum(a["end"] - a["start"] for a in n["ancestors"])
        assert all(a["end"] <= n["start"] for a in n["ancestors"]) and len(n["ancestors"]) == n["depth"]
    starts = {n["start"]: n for n in nodes}
    for n in nodes:  # a subtree is one interval: the parent is on the chain
        if n["ancestors"]:
            parent = starts[n["ancestors"][-1]["start"]]
            assert [a["start"] for a in parent["ancestors"]] == [a["start"] for a in n["ancestors"]][:-1]
            between = [m for m in nodes if parent["start"] < m["start"] < n["start"]]
            assert all(parent["start"] in [a["start"] for a in m["ancestors"]] for m in between)


def test_empty(spark, frame):
    tree, convs = C.prefix_tree(frame([], CONV))
    assert C.digests(C.read_conversations(tree, convs)).count() == 0


def test_query(spark, scratch):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op1_prefix_tree(spark, sf).collect()}
    assert got == brute([*rows, (-7, 0, "user", probe), (-7, 1, "assistant", probe)])
