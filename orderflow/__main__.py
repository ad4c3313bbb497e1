import sys

from orderflow.cli import main

sys.exit(main())
