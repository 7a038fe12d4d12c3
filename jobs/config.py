"""Configuration files and command lines of the jobs."""

from __future__ import annotations

import argparse
import logging
import tomllib
from pathlib import Path


def load(path: str | None, defaults: str) -> dict:
    """The values of a TOML file; without one, of the file that lies beside the job."""
    with open(path or Path(__file__).with_name(defaults), "rb") as f:
        return tomllib.load(f)


def arguments(about: str, **paths: str) -> argparse.Namespace:
    """Parsed arguments: a required path for each keyword, with its help, and ``--config``."""
    parser = argparse.ArgumentParser(description=about)
    for name, text in paths.items():
        parser.add_argument(f"--{name}", required=True, help=text)
    parser.add_argument("--config", help="a TOML file in place of the one beside the job")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return parser.parse_args()
