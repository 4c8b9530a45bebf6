"""spark-submit entry for the mart build; see costmart/plans/cli.py."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costmart.plans.cli import main  # noqa: E402

if __name__ == "__main__":
    main()
