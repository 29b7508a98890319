"""``python -m zonelake <job> ...``: see ``zonelake.plans.cli``."""

import sys

from zonelake.plans.cli import main

sys.exit(main())
