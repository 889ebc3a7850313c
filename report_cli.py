"""spark-submit entry point: ``spark-submit --py-files spendlens.zip report_cli.py run ...``.

Same arguments as ``python -m spendlens`` (run / explain / schema from a vars file).
"""

import sys

from spendlens.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
