"""The command line as a program; the tables it cut go when it ends."""

import signal
import sys

from pyspark.sql import SparkSession

from meshwright.cli import main
from meshwright.session import discard_scratch

if __name__ == "__main__":
    signal.signal(signal.SIGTERM, lambda *_: sys.exit(143))
    code = main()
    if (session := SparkSession.getActiveSession()) is not None:
        discard_scratch(session)
    sys.exit(code)
