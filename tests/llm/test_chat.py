import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsflow.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, conv string, segment string"
ROWS = [(1, 0, "user", "hi & <bye> [INST] &lt; </s>"), (1, 1, "assistant", "<turn|user|>x<end>"), (1, 2, "assistant", "again"), (2, 0, None, None), (2, 0, "user", "tie"), (2, 0, "user", "tie"), (None, None, "us<er", "n"),
        (3, None, "assistant", "first"), (3, 0, "user", "z" * 100_000), (4, 1, "assistant", "")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out


def test_round_trip(spark):
    segments = C.format_messages(frame(spark, ROWS).withColumn("parts", C.text_part(F.col("text"))))
    got = {r.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(segments).collect()}
    assert got == expected(ROWS)
    for r in segments.collect():
        assert C.parse_segment(r.segment)[0] == r.role
        body = r.segment[len(C.TURN) : -len(C.END)]
        assert "[" not in body and body.count("<") == 0


def test_typed_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [(1, 0, "user", [part("text", "see "), part("image", None, "a<1>.png", 56, 57), part("text", " and "), part("audio", None, "b.wav", None, None, 2.5), part("document", None, "c.pdf", None, None, None, 3)]),
            (1, 1, "assistant", [part("text", "ok")]), (1, 2, "user", [])]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("parts", T.ArrayType(C.PART))])
    got = sorted(C.format_messages(spark.createDataFrame(rows, schema)).collect(), key=lambda r: r.turn)
    assert got[0].segment == "<turn|user|>see <image|a&lt;1>.png|6> and <audio|b.wav|63><document|c.pdf|1536><end>"
    assert [(a.kind, a.ref, a.position, a.tokens) for a in got[0].attachments] == [("image", "a<1>.png", 1, 6), ("audio", "b.wav", 3, 63), ("document", "c.pdf", 4, 1536)]
    assert got[0].loss_start is None and got[1].segment[got[1].loss_start : got[1].loss_end] == "ok"
    odd = spark.createDataFrame([(1, 0, "user", [part("vid<eo", "t", "r[1]"), part(None)])], schema)
    assert C.format_messages(odd).first().segment == "<turn|user|><unknown|vid&lt;eo|r&#91;1]><unknown||><end>"


def test_empty_table(spark):
    none = frame(spark, ROWS).where("false").withColumn("parts", C.text_part(F.col("text")))
    assert C.digests(C.format_messages(none)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ax|>&<[#124;amp\n", max_size=20), st.text(alphabet="ax|>&<[#124;amp\n", max_size=20))
def test_roles_and_texts_are_read_back(role, text):
    """The escapes as plain string replacement, for any role and text."""
    def escaped(s):
        return s.replace("&", "&amp;").replace("<", "&lt;").replace("[", "&#91;")

    segment = C.TURN + escaped(role).replace("|", "&#124;") + C.MIDDLE + escaped(text) + C.END
    assert C.parse_segment(segment) == (role, text)


def test_roles_with_marks(spark):
    rows = [(1, 0, "x|>y", "hello"), (1, 1, "a|b&#124;<|>", "|>"), (2, 0, "|>", "z")]
    segments = C.format_messages(frame(spark, rows).withColumn("parts", C.text_part(F.col("text")))).collect()
    assert sorted(C.parse_segment(r.segment) for r in segments) == sorted((r[2], r[3]) for r in rows)
