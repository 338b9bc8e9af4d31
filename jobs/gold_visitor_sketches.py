from reelstat.plans.cli import gold_visitor_sketches

if __name__ == "__main__":
    print("[gold_visitor_sketches] rows written:", gold_visitor_sketches())
