"""Entry point; as a file it may be given to ``spark-submit`` without installing the package."""

import os
import sys

if not __package__:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dockpulse.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
