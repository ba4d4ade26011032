from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from periodstats.session import local_session, shared_dir  # noqa: E402

from fixtures import feature_rows, season_frames  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app_name="periodstats-tests")
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # installs a checkpoint folder when the session has none
    yield s


@pytest.fixture()
def synthetic(spark):
    """Two seasons, 16 players each, schema change and team-id reuse (see FIXTURES.md A)."""
    return season_frames(spark)


@pytest.fixture()
def sample_features(spark):
    return feature_rows(spark)
