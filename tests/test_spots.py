"""Places of matches in a text: as Python's own search finds them, with the text worked out once."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions import pages


def test_spots_are_those_of_a_search(spark):
    rng = random.Random(3)
    bits = ["a", "b", ".", "@", "_", "-", "é", "😀", " ", ".co", "x@y.zz", "vendor", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["", "a@b.com_x@y.com a@b.cc@d.ee"]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select("x", pages.spots(F.col("x"), pages._EMAIL).alias("s")).collect()
    assert any(len(r.s) > 1 for r in got)
    for r in got:
        assert [tuple(s) for s in r.s] == [(*m.span(), m.group()) for m in re.finditer(vocab.EMAIL, r.x)]


def test_the_text_is_worked_out_once(spark):
    said = F.concat(F.lit("zzmark"), F.col("id").cast("string"))
    for found in (pages.vendor_email(said), pages.contact_roles(said)):
        plan = spark.range(3).select(found.alias("y"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("zzmark") == 1
