"""Launcher for spark-submit (which runs a file, not a module).

    zip -r ohlcflow.zip ohlcflow
    spark-submit --py-files ohlcflow.zip submit.py chain --csv s3a://.../prices --out s3a://.../bars
"""

import sys

from ohlcflow.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
