"""Command line: collect, extract, clean, analyze, visualize, report, run, index, ask, check."""

from __future__ import annotations

import argparse
import sys

COMMANDS = ("collect", "extract", "clean", "analyze", "visualize", "report", "run", "index", "ask", "check")


def main(argv: list[str] | None = None) -> int:
    """0 on success, 1 on an error, 130 when interrupted."""
    parser = argparse.ArgumentParser(prog="talkloom", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("question", nargs="?", default="")
    parser.add_argument("--config", default="event.toml")
    parser.add_argument("--top-k", type=int, default=0)
    parser.add_argument("--types", default="")
    parser.add_argument("--track", default=None)
    parser.add_argument("--cpus", type=int, default=8)
    args = parser.parse_args(argv)
    try:
        from talkloom.plans import config, preflight, providers
        from talkloom.plans.job import Job
        from talkloom.session import local_session, ship

        if args.command == "check":
            print("\n".join(f"{k}: {'yes' if v else 'no'}" for k, v in providers.capabilities().items()))
            for step, needs in preflight.checks(config.Config()).items():
                print(f"{step}: " + ", ".join(f"{name} {'yes' if there else 'no'}" for name, there in needs.items()))
            return 0
        settings = config.load(args.config)
        spark = local_session(args.cpus)
        ship(spark)
        job = Job(spark, settings)
        if args.command == "ask":
            print(job.ask(args.question, args.top_k, [x for x in args.types.split(",") if x] or None, args.track))
        elif args.command == "extract":
            stands = job.extract()
            print("\n".join(stands) or "Nothing is missing.")
            return 1 if stands else 0
        else:
            getattr(job, args.command)()
        return 0
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
