"""``python -m shopscope JOB [SHOP PAY VIEW] [options]`` runs a job (see plans/cli.py)."""

from shopscope.plans.cli import main

if __name__ == "__main__":
    main()
