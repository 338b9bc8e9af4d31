from reelstat.plans.cli import gold_dim_media

if __name__ == "__main__":
    print("[gold_dim_media] rows written:", gold_dim_media())
