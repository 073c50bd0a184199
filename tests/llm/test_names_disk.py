"""The search for spellings takes little disk."""

import random

from linkloom.llm.names import shards, trie_links
from linkloom.runtime import Scratch


def test_search_shuffles_packed_rows(spark):
    # the texts and the beginnings of 3,000 cores went through the shuffle as single rows, twice.
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdeilnorst") for _ in range(n))
    made = [f"{word(6)} {word(7)}" for _ in range(1500)]
    made += [m[:i] + "x" + m[i + 1 :] for m in made if (i := r.randrange(5)) >= 0]
    unique = spark.createDataFrame(list(enumerate(sorted(set(made)))), "id long, core string")
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def total():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    found = trie_links(shards(unique), Scratch(spark, "names"))
    assert found.count() >= 1450
    # 3,421,054 bytes as single rows, 2,036,560 packed.
    assert total() - before < 2_700_000

