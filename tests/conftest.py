import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", 8)
    yield s


@pytest.fixture(scope="session")
def sample_pdf():
    """The reference's unit-test table: 1,000 rows, seed 42 (FIXTURES.md 1)."""
    rng = np.random.default_rng(42)
    n = 1000
    return pd.DataFrame({
        "age": rng.integers(18, 80, n).astype("int32"),
        "job": rng.choice(["admin", "technician", "services", "management"], n),
        "marital": rng.choice(["married", "single", "divorced"], n),
        "education": rng.choice(["primary", "secondary", "tertiary"], n),
        "balance": rng.normal(1000, 5000, n),
        "housing": rng.choice(["yes", "no"], n),
        "loan": rng.choice(["yes", "no"], n),
        "y": rng.choice([0, 1], n, p=[0.8, 0.2]).astype("int32"),
    })


@pytest.fixture(scope="session")
def sample_df(spark, sample_pdf):
    return spark.createDataFrame(sample_pdf)
