"""Launcher for the file -> table job.

    spark-submit --py-files pricetide.zip ingest_job.py --source <files> --target <table folder> ...

(locally: ``python -m pricetide.plans.ingest ...``). Arguments: see
``pricetide.plans.ingest.main``.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricetide.plans.ingest import main  # noqa: E402

if __name__ == "__main__":
    main()
