"""spark-submit entry: ``spark-submit payguard_job.py stream|produce [--name value ...]``
(see :mod:`payguard.jobs`)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from payguard.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
