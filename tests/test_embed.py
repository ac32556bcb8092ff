import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from caseloom.operators.embed import hashed_embedding, tokens


def python_vector(text, dim):
    v = np.zeros(dim)
    for tok in re.findall(r"[^\W_]+", text.lower()):
        h = hashlib.md5(tok.encode()).hexdigest()
        v[int(h[:4], 16) % dim] += 1.0 if int(h[4], 16) < 8 else -1.0
    return v


def test_hashed_embedding_deterministic(spark):
    texts = ["Parcel late, parcel LATE!", "Émile's mug—broken_glass 42", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", hashed_embedding(16)(tokens(F.col("t"))).alias("v")).collect()
    for r in rows:
        if r.t is None:
            assert r.v is None
        else:
            assert len(r.v) == 16
            assert np.allclose(r.v, python_vector(r.t, 16))
