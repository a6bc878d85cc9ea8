"""What near-duplicate search sends through joins, and what its processes hold."""

import pickle

import pyarrow as pa

from rankfold.llm import hashing, minmax, spaced
from tests.llm.test_pairs import frame


def test_texts_of_near_copies_are_not_joined(spark, monkeypatch):
    joins = []

    def watched(df, name, write=minmax.written_table):
        if name == "sets":
            joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, name)
    monkeypatch.setattr(minmax, "written_table", watched)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words, "x"]), "something else of another kind"]
    assert [r.component_id for r in minmax.classes(frame(spark, texts)).orderBy("doc_id").collect()
            ] == [0, 0, 2]
    # only the sets made of the texts that the filter lets pass
    assert joins and max(joins) == 1


def test_seeds_of_a_part_are_small():
    """Every task's process keeps them, one that waits for its next task too."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:n]) for n in (2, 3, 8, 60)]
    seeds = spaced.Seeds(pa.array([1, 2, 3, 4]), pa.array([0] * 4), pa.array(texts))
    assert all(len(own) for own, _, _ in seeds.masks)
    assert len(pickle.dumps(seeds)) < 20e6
    _, _, data, off = next(hashing.slices(pa.array([" ".join(["x", *words]), "w1 w2"])))
    assert {r[:2] for r in spaced._find(data, off, seeds)} == {(0, 1), (0, 2), (0, 3)}


def test_tasks_of_near_copies_hand_back_their_memory(monkeypatch):
    done = []
    monkeypatch.setattr(hashing, "hand_back", lambda: done.append(1))
    assert not [*minmax._confirm(iter([]), 85), *minmax._blocks(iter([]), 85)]
    assert len(done) == 2
