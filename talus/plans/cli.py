"""Command line: ``python -m talus.plans.cli --cfg FILE``.

Exit code 1 if the file is missing or the run breaks off, 0 otherwise, early
ends included.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from pathlib import Path

from talus.plans import workflow
from talus.sources import config

log = logging.getLogger("talus")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Select scenarios from a hazard directory.")
    parser.add_argument("--cfg", required=True, help="configuration file")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    handler = None
    try:
        cfg = config.read_config(args.cfg)
        try:
            folder = config.resolve_paths(cfg).output
        except Exception:
            folder = Path(os.getcwd())
        handler = workflow.start_log(folder)
        workflow.run(cfg)
    except Exception:
        log.exception("the run broke off")
        return 1
    finally:
        if handler is not None:
            log.removeHandler(handler)
            handler.close()
    return 0


if __name__ == "__main__":
    sys.exit(main())
