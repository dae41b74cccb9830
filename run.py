"""For ``spark-submit --py-files orderloom.zip run.py <command> ...``."""

import sys

from orderloom.__main__ import main

sys.exit(main())
