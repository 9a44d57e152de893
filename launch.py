"""spark-submit launch.py RUN --data DIR --out DIR ...: starts one of the batch runs."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyrec.plans.runs import main  # noqa: E402

if __name__ == "__main__":
    main()
