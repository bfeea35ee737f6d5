"""``python -m pitwall <ingest|landing|run> ...`` (same as pitwall/cli.py)."""
import sys

from pitwall.cli import main

sys.exit(main())
