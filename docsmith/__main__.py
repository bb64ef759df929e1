"""``python -m docsmith ...`` runs the rebuild job (see ``docsmith.job``)."""

from .job import main

main()
