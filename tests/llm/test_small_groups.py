"""Rows of small groups are judged by the estimate of their language, or of all rows."""

import random

from ionloom.llm import quality_rules
from tests.llm.conftest import make, prose


def test_small_groups_are_judged(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(50, 90)), "en", f"site{i % 40}") for i in range(200)]  # five rows a source
    rows += [(300 + i, prose(rng, rng.randrange(50, 90)), lang, "s") for i, lang in enumerate(["xx", None, "xx", None])]
    noise = lambda: prose(rng, 60).replace(" ", " ### $$$ ")
    odd = [(1000, noise(), "en", "site3"), (1001, noise(), "en", None), (1002, noise(), "xx", "s"), (1003, noise(), None, None)]
    got = quality_rules.quality_rules(make(spark, rows + odd)).collect()
    assert len(got) == len(rows + odd) and all(r.d2 is not None and not r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == {r[0] for r in odd}
    few = quality_rules.quality_rules(make(spark, rows[:3] + odd[:1])).collect()  # too few rows in all
    assert len(few) == 4 and all(r.d2 is None and r.kept for r in few)
