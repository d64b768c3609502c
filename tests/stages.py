"""What a run leaves in the folder of stage tables."""

from __future__ import annotations

import os

from milepost.session import stage_folder


def stage_root(spark) -> str:
    return os.path.dirname(stage_folder(spark)).removeprefix("file:")


def stage_tables(spark) -> set[str]:
    """Folders of the stage tables that are there."""
    return set(os.listdir(stage_root(spark))) if os.path.isdir(stage_root(spark)) else set()
