import os
import sys
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyrec.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


N_RATINGS, N_USERS, N_PRODUCTS = 330, 22, 28


@pytest.fixture(scope="session")
def ratings(spark):
    """Ratings in which low numbers are more active; pairs may repeat, everybody occurs."""
    rng = np.random.default_rng(20_240)
    n = N_RATINGS - N_PRODUCTS
    users = np.concatenate((np.arange(N_PRODUCTS) % N_USERS, (N_USERS * rng.random(n) ** 1.4).astype(int)))
    products = np.concatenate((np.arange(N_PRODUCTS), (N_PRODUCTS * rng.random(n) ** 1.2).astype(int)))
    stars = rng.choice([1, 2, 3, 4, 5], N_RATINGS, p=[0.1, 0.1, 0.2, 0.35, 0.25])
    days = rng.integers(17_000, 19_000, N_RATINGS)
    table = pa.table(
        {
            "user_id": [f"u{i}" for i in users],
            "product_id": [f"p{i}" for i in products],
            "rating": pa.array(stars.astype(np.float32)),
            "timestamp": pa.array(days * 86_400 + rng.integers(0, 86_400, N_RATINGS)),
        }
    )
    return spark.createDataFrame(table)


@pytest.fixture(scope="session")
def vectors(spark):
    """Unit vectors of products p0..p19."""
    return spark.createDataFrame(unit_vectors(20, 16, "p", 42))


def unit_vectors(n, dim, prefix, seed):
    rows = np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return pa.table(
        {"product_id": [f"{prefix}{i}" for i in range(n)], "embedding": [list(r) for r in rows]}
    )


def rows(df, *columns):
    """The rows as sorted tuples."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
