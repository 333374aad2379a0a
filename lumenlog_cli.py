"""Launcher for spark-submit (which runs a file, not a module):

    spark-submit [--packages ...] lumenlog_cli.py stream|report ...
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lumenlog.cli import main  # noqa: E402

if __name__ == "__main__":
    main()
