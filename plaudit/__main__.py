import sys

from plaudit.cli import main

sys.exit(main())
