from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.operators.chunks import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, chunk_rows, split_text


def brute_force(text, size, overlap, separators=SEPARATORS):
    """The rule of SURVEY 2.5.1, on lists of strings."""
    def merge(pieces):
        out, pending, total = [], [], 0
        for piece in pieces:
            if total + len(piece) > size and pending:
                out.append("".join(pending))
                while pending and (total > overlap or (total + len(piece) > size and total > 0)):
                    total -= len(pending.pop(0))
            pending.append(piece)
            total += len(piece)
        return [*out, "".join(pending)] if pending else out

    def split(part, seps):
        sep = next(s for s in seps if s == "" or s in part)
        finer = seps[seps.index(sep) + 1:]
        if sep:
            first, *rest = part.split(sep)
            pieces = [p for p in [first, *[sep + r for r in rest]] if p]
        else:
            pieces = list(part)
        out, pending = [], []
        for piece in pieces:
            if len(piece) < size:
                pending.append(piece)
                continue
            out += merge(pending)
            pending = []
            out += split(piece, finer) if finer else [piece]
        return out + merge(pending)

    return [c for c in (chunk.strip() for chunk in split(text, separators)) if c] if text else []


words = st.text(alphabet="ab. \n", max_size=300)


@settings(max_examples=400, deadline=None)
@given(words, st.integers(2, 30), st.integers(0, 10))
def test_split_equals_brute_force(text, size, overlap):
    overlap = min(overlap, size - 1)
    assert split_text(text, size, overlap) == brute_force(text, size, overlap)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="xyé", max_size=1200), st.sampled_from([". ", " ", "", "\n", "..", "\n\n"])),
                max_size=12))
def test_split_default_sizes(parts):
    text = "".join(a + b for a, b in parts)
    found = split_text(text)
    assert found == brute_force(text, CHUNK_SIZE, CHUNK_OVERLAP)
    assert all(len(chunk) <= CHUNK_SIZE for chunk in found)


def test_cases():
    assert split_text("") == []
    assert split_text("a" * 300 + "." + "b" * 300) == ["a" * 300 + "." + "b" * 300]
    assert split_text("a" * 500 + "." + "b" * 500) == ["a" * 500, "." + "b" * 500]
    assert [len(c) for c in split_text("a" * 2000)] == [800, 800, 700]


def test_chunk_rows_strip_and_keep_the_index(spark):
    texts = {1: "a" * 500 + "." + "b" * 500, 2: "", 3: "...", 4: "a" * 800 + ".." + "b" * 799}
    rows = spark.createDataFrame(list(texts.items()), "article_id BIGINT, content STRING")
    found = {(r[0], r[1]): r[2] for r in chunk_rows(rows).collect()}
    stripped = {(k, i): chunk.lstrip(". ,!?\n\t") for k, text in texts.items()
                for i, chunk in enumerate(brute_force(text, CHUNK_SIZE, CHUNK_OVERLAP))}
    assert found == {key: chunk for key, chunk in stripped.items() if chunk}
    assert (4, 0) in found and (4, 1) not in found and (4, 2) in found


def test_texts_go_to_python_in_small_batches(spark):
    """A hundred rows at a time, whatever the Arrow batch: many long texts are never held at once."""
    plan = chunk_rows(spark.range(3).selectExpr("id AS article_id", "repeat('a b. ', 400) AS content"))
    assert "BatchEvalPython" in (text := plan._jdf.queryExecution().executedPlan().toString()) and "ArrowEvalPython" not in text
    assert plan.count() == 3 * len(split_text("a b. " * 400))
